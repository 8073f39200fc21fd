import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.operators import evidence, external, graphs, relational as R, retrieval


def test_canonical_url(spark):
    df = spark.createDataFrame([("HTTPS://Example.COM:443/a?id=2&utm_source=test&b=1#section",), ("http://h",), ("ftp://x/y",), (None,)], "u string")
    assert [r[0] for r in df.select(X.canonical_url(F.col("u"))).collect()] == ["https://example.com/a?b=1&id=2", "http://h/", None, None]
    odd = ["http://h:8080?B=2&a=&c&Ref=x&MC_CID=3&gclid=4", "https://u:p@H/p?q=a%20b+c&q=%E4%BD%A0*~", " https://h/x?a=%zz&&UTM_Source=1 ", "http://h:80/?timestamp=1&share=2"]
    want = ["http://h:8080/?B=2&a=&c=&gclid=4", "https://h/p?q=a+b+c&q=%E4%BD%A0%2A~", "https://h/x?a=%25zz", "http://h/?share=2&timestamp=1"]
    df = spark.createDataFrame([(u,) for u in odd], "u string")
    assert [r[0] for r in df.select(X.canonical_url(F.col("u"))).collect()] == want


def test_promote_and_insert(spark):
    df = spark.createDataFrame([("u", 1, "drop"), ("u", 2, "keep"), ("v", 1, "maybe"), ("v", 2, "drop")], "url string, n int, decision string")
    assert {(r.url, r.n, r.decision) for r in R.promote(df, "url", ["n"], "decision").collect()} == {("u", 1, "keep"), ("v", 1, "maybe")}
    assert R.insert_missing(df, df, ["url"]).count() == 0


def test_accounting(spark):
    have, used = spark.createDataFrame([("a",), ("b",), ("c",)], "ref string"), spark.createDataFrame([("a",), ("b",), ("b",), ("z",)], "ref string")
    assert {(r.ref, r.violation) for r in R.accounting(have, used, "ref").collect()} == {("b", "duplicate"), ("c", "missing"), ("z", "unknown")}


def test_components_against_union_find(spark):
    edges = [(1, 2), (2, 3), (5, 6), (9, 6), (10, 11), *((i, i + 1) for i in range(100, 140)), (7, 7)]
    got = {r.node: r.component for r in graphs.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert got == {n: min(m for m in parent if find(m) == find(n)) for n in parent}


def test_components_of_nothing(spark):
    assert graphs.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_star_cover_holds_every_edge(spark):
    edges = [("r", a, b, 1.0 / (a + b)) for a, b in itertools.combinations(range(7), 2) if (a * b) % 3 != 1]
    rows = graphs.star_cover(spark.createDataFrame(edges, "g string, a bigint, b bigint, weight double"), "g", 4).collect()
    packages = {}
    for r in rows:
        packages.setdefault(r.package, set()).add(r.node)
    assert all(any({a, b} <= p for p in packages.values()) for _, a, b, _ in edges) and max(map(len, packages.values())) <= 4


def test_modularity_and_groups_partition(spark):
    edges = [("r", 1, 2, 0.9), ("r", 2, 3, 0.8), ("r", 3, 4, 0.1), ("r", 4, 5, 0.9)]
    rows = graphs.modularity(spark.createDataFrame(edges, "g string, a bigint, b bigint, weight double"), "g", 3).collect()
    assert sorted(r.node for r in rows) == [1, 2, 3, 4, 5] and max(sum(r.cluster == c for r in rows) for c in {r.cluster for r in rows}) <= 3
    vec = [("k", i, [float(i % 2), 1.0 - i % 2 + i / 100], 10) for i in range(30)]
    parts = graphs.semantic_groups(spark.createDataFrame(vec, "k string, id bigint, vec array<double>, size int"), "k", 8, 100).collect()
    assert sorted(r.id for r in parts) == list(range(30)) and max(sum(r.part == p for r in parts) for p in {r.part for r in parts}) <= 8


def test_packing(spark):
    rows = graphs.packed(spark.createDataFrame([("k", i, 10) for i in range(9)], "k string, id bigint, size bigint"), "k", 4, 8, 1000).collect()
    sizes = [sum(r.batch == b for r in rows) for b in (0, 1)]
    assert sizes == [5, 4]


def test_evidence(spark):
    texts = spark.createDataFrame([(1, "The plant opened^[1]^ in May 2024."), (2, None)], "k int, text string")
    quotes = spark.createDataFrame([(1, 1, "opened^[1]^ in"), (2, 1, "Opened in, May"), (3, 1, "closed"), (4, 2, "x"), (5, 1, "")], "quote_id int, k int, quote string")
    assert {r.quote_id: r.form for r in evidence.matched(texts, quotes, "k").collect()} == {1: "exact", 2: "normalised", 3: None, 4: None, 5: None}
    facts = [("t", 1, "f", "q", "d", False, 0.9, True), ("t", 2, "g", "q", "e", False, 0.9, True), ("u", 3, "f", "q", "d", True, 0.9, True), ("v", 4, "f", "q", "d", True, 0.1, True)]
    df = spark.createDataFrame(facts, "track string, fact_id int, fingerprint string, quote_hash string, document string, authoritative boolean, confidence double, has_quote boolean")
    assert {r.track: (r.picks, r.status) for r in evidence.strength(df, "track").collect()} == {"t": (1, "watchlist"), "u": (1, "candidate"), "v": (0, "watchlist")}


def test_external_calls_only_what_is_missing(spark):
    asked, cached = spark.createDataFrame([(1,), (2,), (3,)], "k int"), spark.createDataFrame([(1, "old")], "k int, answer string")

    def fn(pdf):
        pdf["answer"] = "new"
        return pdf

    out = external.call(asked, cached, "k", fn, "k int, answer string")
    assert {(r.k, r.answer) for r in out.collect()} == {(1, "old"), (2, "new"), (3, "new")}
    good, bad = external.checked(asked, cached, "k", fn, "k int, answer string")
    assert good.count() == 3 and bad.count() == 0
    assert len(external.stub_embedding(spark.createDataFrame([(1, "ab"), (2, None)], "k int, t string"), "k", "t", 8).collect()[0].vec) == 8


def test_quality_gate(spark):
    df = spark.createDataFrame([(None,), ("　 ",), ("Please Enable\u3000 JavaScript",), ("short",), ("word\n" * 400,), ("A long line of prose that is fine.\n" * 10,)], "t string")
    both = [X.quality_gate(F.col("t"), 50), X.quality_gate(F.col("t"), 50, True)]
    rows = df.select(both[0][1], both[0][0], both[1][0]).collect()
    assert [r[0] for r in rows] == ["empty_body", "empty_body", "access_or_javascript_placeholder", "body_below_minimum_length", "no_substantive_paragraphs", "ok"]
    other, ocr = "remote_reader_required", "ocr_required"
    assert [r[1] for r in rows] == [other] * 5 + ["usable"] and [r[2] for r in rows] == [ocr, ocr, other, ocr, other, "usable"]


def test_numbers_regions_and_scope(spark):
    df = spark.createDataFrame([("投资 3.5 亿元，12台，45 %，12台，7 天",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(X.material_numbers(F.col("t"))).collect()] == [["3.5 亿元", "12台", "45 %"], [], None]
    names = ["广西壮族自治区", "西藏自治区", "北京市", "浦东新区", "云县", None]
    df = spark.createDataFrame([(n,) for n in names], "r string")
    assert [r[0] for r in df.select(X.region_alias(F.col("r"))).collect()] == ["广西", "西藏", "北京", "浦东新区", "云县", None]
    df = spark.createDataFrame([("国务院通知", "全国"), ("广西的项目", "全国"), ("广西的项目", "广西壮族自治区"), ("x", None)], "q string, r string")
    assert [r[0] for r in df.select(X.is_regional(F.col("q"), F.col("r"))).collect()] == [True, False, True, None]
    df = spark.createDataFrame([(["海南省", "海南省", "甲"],), (["甲", "全国"],), ([],), (None,)], "r array<string>")
    got = [r[0] for r in df.select(X.expanded_scope(F.col("r"))).collect()]
    assert got[0] == ["海南省", "甲"] and got[1] == ["全国", *X.REGIONS, "甲"] and got[2:] == [[], None] and len(X.REGIONS) == 31


def test_json_and_tf_idf(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('so: {"a": {"b": 2}} done',), ("no {json}",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(X.json_object(F.col("t"))).collect()] == ['{"a": 1}', '{"a": {"b": 2}}', None, None, None]
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (3, None)]
    got = {(r.id, r.term): r.weight for r in retrieval.tf_idf(spark.createDataFrame(rows, "id int, term string")).collect()}
    assert set(got) == {(1, "a"), (1, "b"), (2, "a")} and got[1, "a"] == 0 and abs(got[1, "b"] - math.log(1.5)) < 1e-12


def test_representatives_differ_in_kind_and_title(spark):
    rows = [("t", 1, "b", "x"), ("t", 2, "a", "y"), ("t", 3, "b", "y"), ("t", 4, "c", "z"), ("u", 5, None, None), ("v", 6, "a", "x"), ("v", 7, "a", "x"), ("v", 8, "a", "w"), ("w", 9, "a", "x"), ("w", 10, "b", "x")]
    df = spark.createDataFrame(rows, "k string, id int, kind string, title string")
    got = {(r.k, r.id, r.pick) for r in evidence.representatives(df, "k", "kind", "title", "id").collect()}
    assert got == {("t", 2, 1), ("t", 1, 2), ("u", 5, 1), ("v", 6, 1), ("v", 8, 2), ("w", 9, 1)}


def test_quotes_are_located(spark):
    texts = spark.createDataFrame([(1, "报告称^[3]^，销量 达12台。后来又说出口增长明显加快了。"), (2, None), (3, "İx ABC")], "page bigint, text string")
    quotes = [(1, 1, "销量 达12台"), (2, 1, "称，销量达12台"), (3, 1, "报告称销量达12台…短…出口增长，明显加快了"), (4, 1, "没有"), (5, 2, "x"), (6, 1, None), (7, 3, "abc"), (8, 1, "...")]
    df = spark.createDataFrame(quotes, "quote_id bigint, page bigint, quote string")
    got = {(r.quote_id, r.part): (r.start, r.found) for r in evidence.located(texts, df, "page").collect()}
    assert got == {(1, 1): (10, "销量 达12台"), (2, 1): (3, "称^[3]^，销量 达12台"), (3, 1): (1, "报告称^[3]^，销量 达12台"), (3, 3): (22, "出口增长明显加快了"), (7, 1): (4, "ABC")}


def test_zero_pairs_count_in_the_statistics(spark):
    docs = spark.createDataFrame([(1, ["ab", "bc", "ab"]), (2, ["xy"]), (3, ["zz"])], "id int, grams array<string>")
    asked = spark.createDataFrame([(7, ["ab", "ab", "q"]), (8, ["xy"])], "id int, grams array<string>")
    pairs = retrieval.bm25(docs, asked)
    got = {(r.query_id, r.doc_id): r for r in pairs.collect()}
    idf = math.log(1 + (3 - 1 + 0.5) / 1.5)
    assert set(got) == {(7, 1), (8, 2)} and abs(got[7, 1].coverage - 0.5) < 1e-12 and got[7, 1].matched_rare == (idf >= 1.5)
    assert abs(got[7, 1].score - idf * 2 * 2.5 / (2 + 1.5 * (0.25 + 0.75 * 3 / (5 / 3)))) < 1e-12
    row = {(r.query_id, r.doc_id): r.hybrid for r in retrieval.fused(pairs, "score", "coverage", 1.0, 6).collect()}
    # of six coverages four are 0: the median is 0, the upper quartile a quarter above it at most
    values = sorted([0, 0, 0, 0, got[7, 1].coverage, got[8, 2].coverage])
    q75 = values[3] + 0.75 * (values[4] - values[3])
    z = min(12, got[7, 1].coverage / max(q75 / 1.349, 1e-8))
    assert abs(row[7, 1] - 1 / (1 + math.exp(-z))) < 1e-9


def test_overlapping_groups(spark):
    rng = np.random.default_rng(4)
    rows = [("k", i, [float(x) for x in rng.standard_normal(8)]) for i in range(50)] + [("one", 99, [1.0] * 8)]
    df = spark.createDataFrame(rows, "k string, id bigint, vec array<double>")
    got = graphs.overlapping_groups(df, "k", 8, 0.25).toPandas()
    primary = got[got.role == "primary"]
    assert sorted(primary.id) == [*range(50), 99] and primary.groupby(["k", "part"]).size().max() <= 6
    assert got.groupby(["k", "part"]).size().max() <= 8 and not got.duplicated(["k", "part", "id"]).any()
    # no two groups of a key could still be put together
    sizes = sorted(primary[primary.k == "k"].groupby("part").size())
    assert sizes[0] + sizes[1] > 6
    v = {i: np.array(x) / np.linalg.norm(x) for _, i, x in rows}
    for (_, _), g in got[got.k == "k"].groupby(["k", "part"]):
        own, near = list(g[g.role == "primary"].id), list(g[g.role == "context"].id)
        score = {i: max(v[i] @ v[j] for j in own) for i in range(50) if i not in own}
        assert near == sorted(score, key=lambda i: (-score[i], i))[: len(near)] and len(near) == min(2, 8 - len(own))


def test_compatible_takes_the_first_fit(spark):
    angle = lambda d: [math.cos(math.radians(d)), math.sin(math.radians(d))]
    rows = [("a", 1, angle(0)), ("a", 2, angle(25)), ("a", 3, angle(15)), ("b", 4, angle(0))]
    df = spark.createDataFrame(rows, "k string, id bigint, vec array<double>")
    got = {(r.k, r.cluster, r.id) for r in graphs.compatible(df, "k", 0.93).collect()}
    assert got == {("a", 1, 1), ("a", 2, 2), ("a", 1, 3), ("b", 4, 4)}
    with pytest.raises(Exception, match="not zero"):
        graphs.compatible(spark.createDataFrame([("a", 1, [0.0, 0.0])], "k string, id bigint, vec array<double>"), "k", 0.9).collect()


def test_anchor_and_link(spark):
    rows = [("微型逆变器系统", "海上逆变器系统集成", None), ("系统", "系统", None), (None, "x", "x"), ("a", "a", None), ("智能ABC柜", "y", "abc柜类"), ("智能", "智能柜", "智能")]
    df = spark.createDataFrame(rows, "p string, n string, f string")
    assert [r[0] for r in df.select(X.anchor(F.col("p"), [F.col("n"), F.col("f")], X.GENERIC_TERMS)).collect()] == ["逆变器系统", None, None, None, "abc柜", None]
    df = spark.createDataFrame([("采购了一批机器人",), ("采购。机器人",), (None,)], "t string")
    assert [r[0] for r in df.select(X.linked(F.col("t"), "机器人", ["采购"])).collect()] == [True, False, None]


def test_no_query_claims_what_is_not_built():
    from ledgerloom.plans.catalogue import CORE

    assert not {"G10", "G11", "G16", "J10", "K11", "K15", "K16", "P10", "P18", "L5", "F19", "F27", "T1", "T4", "W8"} & {i for ids in CORE.operators.values() for i in ids}


def test_company_forms(spark):
    df = spark.createDataFrame([("甲·乙（集团）　Co., Ltd.", "该企业成立于2001年，法定代表人为张三，注册资本为10万元"), (None, None), ("", "成立于2001年，所属行业为制造")], "n string, p string")
    assert [tuple(r) for r in df.select(X.company_form(F.col("n")), X.is_register_profile(F.col("p"))).collect()] == [("甲乙集团coltd", True), ("", False), ("", False)]


def test_optional_lists(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    assert [R.by_optional(df, "a", v).count() for v in (None, [], [2, 5])] == [3, 0, 1]
