"""Operators of the llm subpackage against brute force on small tables, with nulls, blanks, ties and repeated rows."""

import itertools
import random
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixture, neardup, queries, residue, scans, spans, tokens, vectors, wrapper


def words(rng, n):
    return " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 8))) for _ in range(n))


def edited(rng, text, times):
    for _ in range(times):
        i = rng.randrange(len(text))
        text = text[:i] + rng.choice(string.ascii_lowercase) + text[i + rng.randint(0, 1) :]
    return text


def test_neardup(spark):
    rng = random.Random(5)
    base = [words(rng, 30) for _ in range(40)]
    texts = base + [edited(rng, t, rng.randint(1, 14)) for t in base for _ in range(2)] + [base[0], base[0], None, "", "ab", "   "]
    rows = [(2 * i + (i % 5 == 0), t) for i, t in enumerate(texts)]
    classes, links = neardup.similar_classes(spark.createDataFrame(rows + rows[:9], "uid bigint, text string"), 0.7)
    assert all(r.a < r.b for r in links.collect()) and links.count() == links.select("a", "b").distinct().count()
    pairs = neardup.expanded(classes, links)
    got = {(r.a, r.b) for r in pairs.collect()}
    g = {u: {t[i : i + 5] for i in range(len(t) - 4)} for u, t in rows if t is not None}
    same = {(a, b): len(g[a] & g[b]) / max(1, len(g[a] | g[b])) for a, b in itertools.combinations(sorted(g), 2) if a % 2 == b % 2}
    want = {p for p, s in same.items() if s >= 0.7}
    assert got <= want and len(want - got) <= 0.01 * len(want) and all(same[p] < 0.75 for p in want - got)


def test_neardup_of_nothing(spark):
    assert neardup.expanded(*neardup.similar_classes(spark.createDataFrame([], "uid bigint, text string"), 0.7)).count() == 0


@pytest.mark.parametrize("group", [2, 512])
def test_large_groups_lose_no_link(spark, monkeypatch, group):
    monkeypatch.setattr(neardup, "GROUP", group)
    rng = random.Random(1)
    base = words(rng, 60)
    rows = [(2 * i, edited(rng, base, 3)) for i in range(12)]
    _, links = neardup.similar_classes(spark.createDataFrame(rows, "uid bigint, text string"), 0.7)
    g = {u: {t[i : i + 5] for i in range(len(t) - 4)} for u, t in rows}
    want = {(a, b) for a, b in itertools.combinations(sorted(g), 2) if len(g[a] & g[b]) / len(g[a] | g[b]) >= 0.7}
    assert {(r.a, r.b) for r in links.collect()} == want


def test_large_groups_are_paired_by_one_shared_band(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 0.25, raising=False)
    rng = random.Random(1)
    base = words(rng, 20)
    rows = [(2 * i, edited(rng, base, 1 + i % 2)) for i in range(530)]
    signatures = neardup._signatures

    def one_band(batches):  # all records share the first band, and no other
        for b in signatures(batches):
            keys = np.array(b.column("keys").to_pylist()).reshape(-1, neardup.BANDS)
            keys[:] = b.column("uid").to_numpy()[:, None] * 100 + np.arange(neardup.BANDS)
            keys[:, 0] = -7
            yield b.set_column(1, "keys", pa.array(keys.tolist(), pa.list_(pa.int64())))

    monkeypatch.setattr(neardup, "_signatures", one_band)
    pairs = neardup.expanded(*neardup.similar_classes(spark.createDataFrame(rows + rows[:4], "uid bigint, text string"), 0.7))
    g = {u: {t[i : i + 5] for i in range(len(t) - 4)} for u, t in rows}
    want = {(a, b) for a, b in itertools.combinations(sorted(g), 2) if len(g[a] & g[b]) / len(g[a] | g[b]) >= 0.7}
    got = {(r.a, r.b) for r in pairs.collect()}
    assert len(want) > 100_000 and got <= want and len(want - got) <= 1e-3 * len(want)


@pytest.mark.parametrize("group", [2, 512])
def test_groups_are_the_components_of_the_links(spark, monkeypatch, group):
    monkeypatch.setattr(neardup, "GROUP", group)
    rng = random.Random(11)
    rows, uid = [], 0
    for _ in range(25):
        text = words(rng, 40)
        for _ in range(rng.randint(1, 6)):
            rows.append((uid, text))
            text = edited(rng, text, rng.randint(0, 12))  # chains: the ends of a group need not be similar
            uid += 2
    rows += [(uid, None), (uid + 2, ""), (uid + 4, ""), (uid + 6, "ab"), rows[0], rows[3]]
    df = spark.createDataFrame([(u, t, 7) for u, t in rows], "uid bigint, text string, part int")
    got = {r.uid: r.group for r in neardup.similar_groups(df, 0.7).collect()}
    texts = dict(rows)
    root = {u: u for u in texts}

    def find(u):
        while root[u] != u:
            u = root[u]
        return u

    for a, b in [(r.a, r.b) for r in neardup.expanded(*neardup.similar_classes(df, 0.7)).collect()]:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    sizes = {}
    for u in texts:
        sizes.setdefault(find(u), []).append(u)
    assert got == {u: g for g, us in sizes.items() if len(us) > 1 for u in us}


def test_a_large_group_costs_rows_in_proportion(spark, monkeypatch):
    rng = random.Random(12)
    base, n = words(rng, 50), 5000
    counts = {}
    materialise = neardup.materialise

    def counted(df, label):
        out = materialise(df, label)
        counts[label] = counts.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(neardup, "materialise", counted)
    df = spark.createDataFrame([(2 * i, edited(rng, base, 2) + f" {i}") for i in range(n)], "uid bigint, text string")
    rows = neardup.similar_groups(df, 0.7).agg(F.count("*"), F.countDistinct("group")).first()
    assert tuple(rows) == (n, 1)
    assert counts["stars"] <= neardup.BANDS * n and counts["proposed"] <= 2 * neardup.BANDS * n and counts["crossing"] == 0


def test_large_groups_give_each_pair_once():
    keys = np.arange(4 * neardup.BANDS).reshape(4, -1) * 10
    keys[:, 3] = keys[:, 7] = 5  # two shared bands of one group
    table = pa.table({"hot": [5] * 4, "a": [2, 4, 6, 8], "part": [2, 4, 6, 6], "own": [0] * 4, "i": [0] * 4, "j": [0] * 4, "keys": keys.tolist(), "words": [[1] * neardup.WORDS] * 4})
    least = neardup.least_matches(0.7, neardup.TOLERANCE)
    got = neardup._block_pairs(table, least).to_pylist()
    assert sorted((r["a"], r["b"]) for r in got) == [(2, 4), (2, 6), (2, 8), (4, 6), (4, 8)]
    other = table.set_column(0, "hot", pa.array([6] * 4))
    assert neardup._block_pairs(other, least).num_rows == 0


@pytest.mark.parametrize("part", [3, 8, 4000])
def test_spans(spark, monkeypatch, part):
    monkeypatch.setattr(spans, "PART", part)
    rng = random.Random(2)
    passages = [words(rng, 60)[:n] for n in (150, 199, 200, 260, 320)]
    docs = []
    for i in range(30):
        parts = [words(rng, rng.randint(5, 60)) + "\n"]
        for p in rng.sample(passages, 2):
            parts += [p, "|" + words(rng, 20)]
        docs.append((i, "".join(parts)))
    docs += [(40, docs[3][1]), (41, docs[3][1]), (42, None), (43, ""), (44, " " * 300), (45, "-" * 400), (46, "-" * 500)]
    df = spark.createDataFrame(docs, "doc bigint, text string")
    classes, found = spans.shared_spans(df)
    got = {(r.doc_a, r.doc_b) for r in spans.sharing_pairs(classes, found).collect()}
    where = {}
    for i, t in docs:
        if t and t.strip():
            for k in range(len(t) - 199):
                where.setdefault(t[k : k + 200], set()).add(i)
    want = {p for s in where.values() for p in itertools.combinations(sorted(s), 2)}
    assert got == want
    covered = {r.doc: r.shared_chars for r in spans.shared_parts(df, classes, found).collect()}
    for i, t in docs:
        mark = bytearray(len(t or ""))
        for k in range(len(t or "") - 199):
            if len(where.get(t[k : k + 200], ())) > 1:
                mark[k : k + 200] = b"\1" * 200
        assert covered[i] == sum(mark), i


def test_vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 16))
    v = [(i, [float(x) for x in centres[i % 30] + 0.2 * rng.standard_normal(16)]) for i in range(600)]
    v += [(700 + i, v[0][1]) for i in range(15)] + [(800, v[5][1]), (800, v[5][1])]
    bad = [(900, None), (901, []), (902, [1.0] * 15), (903, [float("nan")] * 16), (904, [0.0] * 16), (905, [float("inf")] * 16), (906, [None] * 16)]
    got = {(r.vec_a, r.vec_b) for r in vectors.neighbour_pairs(spark.createDataFrame(v + bad, "i bigint, v array<float>"), "i", "v", 16, 10).collect()}
    rows = dict(v)
    ids = np.array(sorted(rows))
    u = np.array([np.asarray(rows[i], dtype=np.float32).astype(float) for i in ids])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    want = set()
    for n, i in enumerate(ids):
        s = np.rint(u @ u[n] * 1e6).astype(int)
        s[n] = -(10**9)
        want |= {(min(i, ids[m]), max(i, ids[m])) for m in np.lexsort((ids, -s))[:10]}
    assert len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(want)


def test_heavy_buckets_get_longer_prefixes(spark, monkeypatch):
    monkeypatch.setattr(vectors, "HEAVY", 120)
    monkeypatch.setattr(vectors, "BUCKET", 100)
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(16)
    close = [(i, [float(x) for x in centre + 0.05 * rng.standard_normal(16)]) for i in range(400)]
    alike = [(1000 + i, [float(x) for x in -centre + 1e-7 * rng.standard_normal(16)]) for i in range(300)]
    rows = close + alike + [(2000 + i, [float(x) for x in rng.standard_normal(16)]) for i in range(300)]
    got = {}
    for r in vectors.nearest(spark.createDataFrame(rows, "id bigint, vec array<float>"), 16, 5).collect():
        got[r.id] = [p.n for p in r.near]
    assert set(got) == {i for i, _ in rows}
    ids = np.array([i for i, _ in rows])
    u = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    found = 0
    for n in range(400):
        s = np.rint(u @ u[n] * 1e6)
        s[n] = -9e9
        found += len({int(ids[m]) for m in np.lexsort((ids, -s))[:5]} & set(got[int(ids[n])]))
    assert found >= 0.9 * 5 * 400
    assert all(len(got[i]) == 5 and all(1000 <= x < 1300 for x in got[i]) for i, _ in alike)


def test_vectors_of_nothing(spark):
    assert vectors.neighbour_pairs(spark.createDataFrame([(1, None)], "i bigint, v array<float>"), "i", "v", 16, 10).count() == 0


def test_tokens(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = ["Hello  world's  12,5\n\n", "泵控制器，第12页。", "🙂 é x y 　", "", None, " ", "<|endoftext|>", "don't we'll\tx\r\n"] * 2
    df = spark.createDataFrame([(i, x, "w") for i, x in enumerate(texts)], "doc bigint, text string, word string")
    coded = tokens.encode(df, "doc", "text", chunk_bytes=40)
    got = {r.doc: r.ids for r in coded.collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    back = {r.doc: r.text for r in tokens.decode(coded, "doc", "ids", tokens.pieces(spark)).collect()}
    assert back == {i: x or "" for i, x in enumerate(texts)}


def test_mixture(spark):
    rng = random.Random(4)
    docs = [(i, "abc"[min(2, i % 7)], rng.randint(1, 50), rng.random()) for i in range(3000)] + [(5000, "a", 0, 1.0), (5001, None, 5, 1.0), (5002, "x", 9, 1.0)]
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.2, 1), ("c", 0.2, None), ("gone", 0.1, 2)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens int, weight double")
    plan = mixture.plan_budgets(df, targets, None)
    out = mixture.mix(df, plan, len(docs))
    rows = {r.source: r for r in mixture.report(plan, out).collect()}
    for s, most in (("a", 3), ("b", 1), ("c", 1)):
        assert 0 <= rows[s].budget - rows[s].mixed_tokens <= 50 and rows[s].most_copies <= most
    assert rows["gone"].mixed_tokens == 0 and abs(rows["a"].actual_share - 0.5 / 0.9) < 0.01
    assert sorted(out.collect()) == sorted(mixture.mix(df, plan, len(docs)).collect())


def heads_of(spark, rows):
    return spark.createDataFrame(rows, "k bigint, title string, url string")


def found_residue(spark, rows, heads):
    df = spark.createDataFrame(rows, "k bigint, text string, host string, title string")
    return sorted(r.k for r in residue.residue(df, lambda keys: heads_of(spark, heads).join(keys, "k"), heads_of(spark, heads), ["k"], "text", "host", "title", "url").collect())


def test_residue_placeholders_and_filler(spark):
    bad = ["Published {{ title }} by X", "__TITLE__", "发布时间：XX年XX月XX日", "占位文本占位文本占位文本", "这里是正文内容这里是正文内容", "Lorem ipsum sed irure sit amet.", "首页 | 视频\nasdf qwer asdf qwer ", "Sample text goes here. Sample text goes here. Sample text"[:50]]
    good = ["平台采用“{{ name }}”这类模板语法，在区部署38套。", "政务网站改版后，404错误率下降59.8%，称页面不存在的提示已统一。", "The firm dropped the lorem ipsum from its manuals.", None, "", " \n", "首页 | 视频"]
    rows = [(i, t, f"h{i}", None) for i, t in enumerate(bad + good)] + [(0, bad[0], "h", None)]
    assert found_residue(spark, rows, []) == list(range(len(bad)))


def test_residue_of_nothing(spark):
    assert found_residue(spark, [], []) == [] and found_residue(spark, [(1, None, None, "clash")], [(1, None, None)]) == []


def test_responses_are_told_by_hosts_and_titles(spark):
    titles = ["pumps for plant", "looms in Velska", "Notice on ceramic kilns", "浦县安排资金", "检漏仪通过验收", "copper bids"]
    texts = {0: "Nothing lives here today, code 9{0}", 100: "News | Jobs\n该文章已被撤下。\nNothing lives here today, code 9{0}", 200: "The {1} were opened by the mayor.", 300: "The same report of one event.", 400: "A line of one host."}
    rows, heads = [], []
    for start, text in texts.items():
        for i, title in enumerate(titles):
            host = "h" if start == 400 else f"h{i}"
            rows.append((start + i, text.format(i, title), host, "clash"))
            heads.append((start + i, "One event and its report" + "!" * i if start == 300 else title, f"http://{host}/news/x{i}"))
    # one more text that is a response with a sentence of content below it
    rows.append((900, "Nothing lives here today, code 91\nThe kilns were sold to a buyer.", "h1", None))
    assert found_residue(spark, rows + rows[:3], heads) == [*range(6), *range(100, 106)]


SCAN = """Survey Results | 12
The share of plants using pumps rose after the review of
many bids, and the committee listed firms that supply fil‐
ters to buyers in the region. The standards pane1 set aside
- 13 -

Survey Results | 14
money for workshops that adopt high-
purity filters, while the alliance keeps part of the con-
tract. The regional fund visited plants and reviewed what
the committee had listed. The share of plants rose again."""


def test_scans(spark):
    corpus = spark.createDataFrame([("The share of plants using pumps rose after the review of many bids, and the committee listed firms that supply filters to buyers. The standards panel set aside money; high purity contract.",)] * 5 + [(None,)], "text string")
    pages = spark.createDataFrame([(1, SCAN), (2, None), (3, ""), (4, "One line."), (1, SCAN)], "id bigint, text string")
    rows = scans.repaired(pages, corpus.where("text is not null")).collect()
    assert [r.id for r in rows] == [1]
    assert {(f.line_no, f.kind) for f in rows[0].found} == {(1, "running_head"), (3, "broken_word"), (4, "garbled"), (5, "page_number"), (7, "running_head"), (9, "broken_word")}
    assert "supply filters to" in rows[0].text and "panel set aside money" in rows[0].text and "high-purity" in rows[0].text and "contract. The" in rows[0].text


def source_of(words, grams=(), confusions=None):
    counts = {scans.key_of(w): n for w, n in words.items()}
    for text in grams:
        for n in (2, 3):
            for i in range(len(text) - n + 1):
                k = scans.gram_key(text[i : i + n])
                counts[k] = counts.get(k, 0) + 50
    return scans.Source(counts, 10_000, confusions or {})


def test_a_known_word_is_decoded_by_its_neighbours():
    source = source_of({"to": 100, "the": 200, "eat": 40, "cat": 40, "to eat": 30, "the cat": 35}, confusions={("c", "e"): 0.01})
    line = lambda text: scans.decode_words(scans.lattice(text, (False, False), source)[1], source)
    assert line("to cat") == ["to", "eat"] and line("the cat") == ["the", "cat"] and line("") == []
    rare = source_of({"to": 100, "eat": 40, "cat": 40, "to eat": 30}, confusions={("c", "e"): 1e-9})
    assert scans.decode_words(scans.lattice("to cat", (False, False), rare)[1], rare) == ["to", "cat"]


def test_viterbi_is_the_best_of_all_paths():
    rng = random.Random(8)
    vocabulary = ["a" + x for x in "bcdefgh"]
    source = source_of({w: rng.randint(1, 50) for w in vocabulary} | {f"{x} {y}": rng.randint(0, 9) for x in vocabulary for y in vocabulary})
    for _ in range(20):
        line = [[(w, -rng.random()) for w in rng.sample(vocabulary, 3)] for _ in range(5)]
        score = lambda path: sum(c + source.after(w, path[i - 1][0] if i else None) for i, (w, c) in enumerate(path))
        best = max(itertools.product(*line), key=score)
        assert scans.decode_words(line, source) == [w for w, _ in best]


def test_adjacent_chinese_signs_are_decoded_together():
    source = source_of({}, ["我们的未来已入住新区"] * 3)
    assert scans.decode_han("我们的末来己入住新区", source) == {3: "未", 5: "已"}
    assert scans.decode_han("我们的未来已入住新区", source) == {} and scans.decode_han("", source) == {}


def test_confusions_are_expected_counts():
    source = source_of({"panel": 50, "the": 90})
    got = scans.expected(["pane1", "the"], "", source)
    assert got[("1", "l")] > 0.99 and sum(got.values()) < 1.01


def test_counts_for_scans_are_exact(spark):
    texts = ["the pump the pump", None, "", "泵控制器。泵控制器。", "the 泵"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").where("text is not null")
    words = {r.key: r.n for r in scans.word_counts(df).collect()}
    assert {w: words.get(scans.key_of(w)) for w in ("the", "pump", "the pump", "pump the", "pump pump")} == {"the": 3, "pump": 2, "the pump": 2, "pump the": 1, "pump pump": None}
    grams = {r.key: r.n for r in scans.gram_counts(df).collect()}
    assert grams[scans.gram_key("泵控")] == 2 and grams[scans.gram_key("泵控制")] == 2 and grams[scans.gram_key("器。泵")] == 1 and scans.gram_key("the") not in grams


def test_scans_without_corpus_or_pages(spark):
    nothing = spark.createDataFrame([], "text string")
    assert scans.repaired(spark.createDataFrame([], "id bigint, text string"), nothing).count() == 0
    rows = scans.repaired(spark.createDataFrame([(1, SCAN)], "id bigint, text string"), nothing).collect()
    assert [r.id for r in rows] == [1]


def test_wrapper(spark):
    rng = random.Random(6)
    pages, site = [], {}
    for i in range(400):
        body = [words(rng, 6), words(rng, 40) + ".", "Background", words(rng, 40) + ".", words(rng, 40) + "."]
        if i % 3:
            lines = ["Home | News | Jobs", f"Page views: {i}", *body, "", "More stories", *[words(rng, 6) for _ in range(2)], f"© 20{i % 90 + 10} The Post"]
            site[i] = {1, 2, 9, 10, 11, 12}
        else:
            lines, site[i] = body, set()
        pages.append((i, f"h{i % 4}", "\n".join(lines)))
    pages += [(900, "h1", None), (901, None, ""), (1, "h1", pages[1][2])]
    got = {}
    for r in wrapper.site_lines(spark.createDataFrame(pages, "id bigint, host string, text string")).collect():
        got.setdefault(r.id, set()).add(r.line_no)
    right = sum(len(got.get(i, set()) & s) for i, s in site.items())
    wrong = sum(len(x - site.get(i, set())) for i, x in got.items())
    assert right >= 0.97 * sum(map(len, site.values())) and wrong <= 0.02 * right


def test_matching_is_simple_tree_matching():
    a, b = [[1, 2, 3], [4, 5]], [[9], [2, 3], [5, 6]]
    assert wrapper.matching(a, b) == {(0, 1), (0, 2), (1, 1)}


def test_nodes_are_counted_exactly_over_units(spark, monkeypatch):
    """One host with all pages, in many units: each unit sends a key once, the sums are over all of them."""
    monkeypatch.setattr(wrapper, "GROUP", 7)
    kept = {}
    materialise = wrapper.materialise
    monkeypatch.setattr(wrapper, "materialise", lambda df, label: kept.setdefault(label, materialise(df, label)))
    pages = [(i, None, f"Home | News\nLine of page {i}x\n\nAll rights by us") for i in range(90)]
    found = wrapper.site_lines(spark.createDataFrame(pages + pages[:4], "id bigint, host string, text string")).collect()
    assert {r.id for r in found if r.line_no == 1} == set(range(90))
    units = kept["trees"].select("unit").distinct().count()
    assert 8 <= units <= 14
    key = wrapper.line_keys("All rights by us", "")[1]
    rows = kept["nodes"].where(F.col("key") == key).collect()
    assert {r.unit for r in rows} == {r.unit for r in kept['trees'].collect()} and {r.n for r in rows} == {90}
    home = kept["nodes"].where(F.col("key") == wrapper.line_keys("Home | News", "")[1]).collect()
    assert {(r.n, r.edge) for r in home} == {(90, 90)}


def test_wrapper_of_nothing(spark):
    assert wrapper.site_lines(spark.createDataFrame([], "id bigint, host string, text string")).count() == 0
    assert wrapper.site_lines(spark.createDataFrame([(1, None, None, 5), (2, "h", " \n", 5)], "id bigint, host string, text string, key int")).count() == 0


def test_wrapper_leaves_out_the_pages_of_residue(spark, tmp_path):
    titles = ["pumps for plant", "looms in Velska", "Notice on ceramic kilns", "浦县安排资金", "检漏仪通过验收", "copper bids"]
    rows = [(i, i, f"http://h{i}/news/x", f"h{i}", "Nothing lives here today", t) for i, t in enumerate(titles)] + [(9, 9, "http://h9/x", "h9", "The plant opened.", "Plant")]
    df = spark.createDataFrame(rows, "page_id bigint, result_id bigint, url string, site string, extracted_text string, title string")
    df.drop("title").write.parquet(f"{tmp_path}/remote_page_result.parquet")
    df.select("result_id", "title", "url", F.lit(None).cast("string").alias("snippet")).write.parquet(f"{tmp_path}/search_result.parquet")
    bad = {r.row_key for r in queries.p6_found(spark, str(tmp_path)).where("src = 'remote_page_result'").collect()}
    assert bad == set(range(6)) and {r.id for r in queries._pages(spark, str(tmp_path)).collect()} == {9}
