"""What must hold for the results of queries without SQL, on real tables."""

import math
import os
import unicodedata

import numpy as np
import pytest

from ledgerloom.plans.catalogue import CORE
from ledgerloom.sources.tables import materialise, release, table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no data")


def rows(spark, name):
    return CORE.queries[name](spark, DATA).toPandas()


@pytest.fixture(scope="module")
def vectors(spark):
    e = table(spark, DATA, "embeddings").toPandas()
    return {i: (label, np.asarray(v, float) / np.linalg.norm(v)) for i, label, v in zip(e.vec_id, e.label, e.embedding, strict=True)}


def test_every_query_without_sql_is_tested_here_or_by_hand():
    tested = {"g02_compatible_names", "g03_semantic_groups", "g04_overlapping_groups", "g08_star_cover", "g08_modularity", "g09_evidence_strength", "g13_packing", "f10_evidence_offsets", "f17_normalise_term", "p2_found", "p3_found"}
    assert set(CORE.queries) - set(CORE.oracles) <= tested


def test_compatible_names(spark, vectors):
    got = rows(spark, "g02_compatible_names")
    assert sorted(got.id) == sorted(vectors)
    for (label, first), g in got.groupby(["label", "cluster"]):
        v = np.stack([vectors[i][1] for i in g.id])
        assert len(g) <= 8 and first == g.id.min() and {vectors[i][0] for i in g.id} == {label} and (v @ v.T).min() >= 0.93 - 1e-6


@pytest.mark.parametrize("name", ["g03_semantic_groups", "g04_overlapping_groups"])
def test_groups_hold_each_member_once(spark, vectors, name):
    got = rows(spark, name)
    primary = got[got.role == "primary"] if "role" in got else got
    assert sorted(primary.id) == sorted(vectors) and got.groupby(["label", "part"]).size().max() <= 12
    assert all(vectors[i][0] == label for i, label in zip(got.id, got.label, strict=True)) and not got.duplicated(["label", "part", "id"]).any()


def edges(spark):
    from ledgerloom.plans.analytics import _edges

    return _edges(spark, DATA).toPandas()


def test_star_cover_holds_every_edge(spark):
    got, e = rows(spark, "g08_star_cover"), edges(spark)
    packages = {k: set(g.node) for k, g in got.groupby(["label", "package"])}
    by_label = {}
    for (label, _), nodes in packages.items():
        by_label.setdefault(label, []).append(nodes)
    assert max(map(len, packages.values())) <= 4
    assert all(any({a, b} <= p for p in by_label[label]) for label, a, b in zip(e.label, e.a, e.b, strict=True))


def test_modularity_parts_the_nodes(spark):
    got, e = rows(spark, "g08_modularity"), edges(spark)
    assert not got.duplicated(["label", "node"]).any() and got.groupby(["label", "cluster"]).size().max() <= 6
    assert set(zip(got.label, got.node, strict=True)) == {(x, n) for x, a, b in zip(e.label, e.a, e.b, strict=True) for n in (a, b)}


def test_packing_is_in_order_and_bounded(spark):
    got = rows(spark, "g13_packing")
    docs = table(spark, DATA, "documents").where("source is not null").toPandas()
    size = {i: 0 if n is None or math.isnan(n) else n for i, n in zip(docs.doc_id, docs.n_chars, strict=True)}
    assert sorted(got.id) == sorted(docs.doc_id)
    for source, g in got.groupby("source"):
        ends = [(b.id.min(), b.id.max(), len(b), sum(size[i] for i in b.id)) for _, b in sorted(g.groupby("batch"))]
        assert all(x[1] < y[0] for x, y in zip(ends, ends[1:], strict=False)), source
        assert all(n <= 8 and (total <= 12_000 or n == 1) for _, _, n, total in ends)


def test_evidence_strength_follows_its_picks(spark):
    got = rows(spark, "g09_evidence_strength")
    assert set(got.status) <= {"candidate", "watchlist"} and (got.picks >= 0).all()
    assert (got[got.picks == 0].status == "watchlist").all() and (got[got.picks >= 2].status == "candidate").all()


def test_located_quotes_stand_where_they_are_said_to(spark):
    got = rows(spark, "f10_evidence_offsets")
    texts = {r.result_id: r.snippet for r in table(spark, DATA, "search_result").collect() if r.snippet}
    assert len(got) > 100
    for q, start, found in zip(got.quote_id, got.start, got.found, strict=True):
        assert texts[q][start - 1 : start - 1 + len(found)] == found


def test_normal_terms(spark):
    got = rows(spark, "f17_normalise_term")
    column = next(c for c in got.columns if got[c].dtype == object and c not in ("topic_id", "track_id"))
    assert all(x is None or x == unicodedata.normalize("NFKC", x).lower() for x in got[column])


def test_tables_can_be_released(spark):
    df = materialise(spark.range(5).toDF("x"), "released")
    assert df.count() == 5 and release(spark) >= 1 and release(spark) == 0
    with pytest.raises(Exception, match="(?i)exist|not found"):
        df.count()
