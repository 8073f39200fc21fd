"""Queries of vectors, graphs, retrieval and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import evidence, graphs, relational, retrieval, vectors
from ..sources.tables import table as T
from .registry import CORE

Q = CORE.add
FLOOR = 0.4
PAIRS = f"""WITH v AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE / greatest(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 1e-12)) AS u FROM embeddings),
e AS (SELECT x.label, x.id AS a, y.id AS b, round(list_dot_product(x.u, y.u), 6) AS similarity FROM v x JOIN v y ON x.label = y.label AND x.id < y.id), p AS (SELECT * FROM e WHERE similarity >= {FLOOR})"""


def _edges(spark, d) -> DataFrame:
    v = T(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec"))
    return vectors.blocked_pairs(v, "label", FLOOR)


@Q("j12_role_blocked_pairs", "J11 J12 F24", PAIRS + " SELECT label, a, b, similarity FROM p")
def _(spark, d):
    return _edges(spark, d)


@Q("u06_symmetrise", "U6", PAIRS + " SELECT src, dst, max(similarity) AS similarity FROM (SELECT a AS src, b AS dst, similarity FROM p UNION ALL SELECT b, a, similarity FROM p) GROUP BY src, dst")
def _(spark, d):
    return vectors.symmetric(_edges(spark, d))


@Q("w04_top_neighbours", "W4 W5", PAIRS + """, s AS (SELECT a AS src, b AS dst, similarity FROM p UNION ALL SELECT b, a, similarity FROM p) SELECT src, dst, similarity FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY similarity DESC, dst) r, max(similarity) OVER (PARTITION BY src) m FROM s) WHERE r <= 5 AND similarity >= m - 0.15""")
def _(spark, d):
    return vectors.top_neighbours(vectors.symmetric(_edges(spark, d)), 5, 0.15)


@Q("w06_gap_cut", "W6", PAIRS + """, s AS (SELECT a AS src, b AS dst, similarity FROM p UNION ALL SELECT b, a, similarity FROM p), g AS (SELECT *, row_number() OVER w AS pos, round(similarity - lead(similarity) OVER w, 6) AS gap FROM s WINDOW w AS (PARTITION BY src ORDER BY similarity DESC, dst)),
m AS (SELECT src, median(gap) AS med, count(*) AS n, max(gap) AS top FROM g GROUP BY src), d AS (SELECT g.src, median(abs(gap - med)) AS mad, min(CASE WHEN gap = top THEN pos END) AS cut FROM g JOIN m USING (src) GROUP BY g.src)
SELECT g.src, g.dst, g.similarity FROM g JOIN m USING (src) JOIN d USING (src) WHERE NOT coalesce(n > 2 AND top > greatest(0.03, med + 3 * mad), false) OR pos <= cut""")
def _(spark, d):
    return relational.gap_cut(vectors.symmetric(_edges(spark, d)), "src", "similarity", [F.desc("similarity"), F.asc("dst")])


@Q("g06_components", "G6", "WITH RECURSIVE" + PAIRS[4:] + """, s AS (SELECT a AS x, b AS y FROM p UNION SELECT b, a FROM p), r AS (SELECT x AS node, x AS reach FROM s UNION SELECT r.node, s.y FROM r JOIN s ON s.x = r.reach) SELECT node, min(reach) AS component FROM r GROUP BY node""")
def _(spark, d):
    return graphs.components(_edges(spark, d))


@Q("g07_recall_edges", "G7", PAIRS + """, q AS (SELECT label, greatest(quantile_cont(similarity, 0.995), 0.1) AS floor FROM e GROUP BY label) SELECT e.label, a, b, round((similarity - floor) / greatest(1 - floor, 1e-6), 4) AS strength FROM e JOIN q USING (label) WHERE similarity >= floor""")
def _(spark, d):
    v = T(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec"))
    every = vectors.blocked_pairs(v, "label", -2.0)
    floors = every.groupBy("label").agg(F.greatest(F.percentile("similarity", F.lit(0.995)), F.lit(0.1)).alias("floor"))
    j = every.join(floors, "label").where("similarity >= floor")
    return j.select("label", "a", "b", F.round((F.col("similarity") - F.col("floor")) / F.greatest(1 - F.col("floor"), F.lit(1e-6)), 4).alias("strength"))


@Q("g08_star_cover", "G8a")
def _(spark, d):
    return graphs.star_cover(_edges(spark, d).withColumnRenamed("similarity", "weight"), "label", 4)


@Q("g08_modularity", "G8b")
def _(spark, d):
    return graphs.modularity(_edges(spark, d).withColumnRenamed("similarity", "weight"), "label", 6)


@Q("g02_compatible_names", "G2")
def _(spark, d):
    return graphs.compatible(T(spark, d, "embeddings").select("label", F.col("vec_id").alias("id"), F.col("embedding").alias("vec")), "label", 0.93)


@Q("g03_semantic_groups", "G3")
def _(spark, d):
    rows = T(spark, d, "embeddings").select("label", F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.lit(500).alias("size"))
    return graphs.semantic_groups(rows, "label", 12, 30_000)


@Q("g04_overlapping_groups", "G4 G5")
def _(spark, d):
    rows = T(spark, d, "embeddings").select("label", F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return graphs.overlapping_groups(rows, "label", 12, 0.25)


@Q("g13_packing", "G13")
def _(spark, d):
    rows = T(spark, d, "documents").where("source is not null").select("source", F.col("doc_id").alias("id"), F.coalesce("n_chars", F.lit(0)).alias("size"))
    return graphs.packed(rows, "source", 4, 8, 12_000)


@Q("g01_observations", "G1 F12", r"""SELECT lower(regexp_replace(label, '[^\p{L}\p{N}_]', '', 'g')) AS name_key, coalesce(definition, '') AS definition, count(*) AS topics FROM topic GROUP BY 1, 2""")
def _(spark, d):
    key = F.lower(F.regexp_replace("label", r"[^\p{L}\p{N}_]", ""))
    return T(spark, d, "topic").groupBy(key.alias("name_key"), F.coalesce("definition", F.lit("")).alias("definition")).agg(F.count("*").alias("topics"))


@Q("g10_market_merge", "G12 U3", """WITH RECURSIVE m AS (SELECT track_id, unnest(topic_ids) AS t FROM track), s AS (SELECT DISTINCT a.track_id AS x, b.track_id AS y FROM m a JOIN m b ON a.t = b.t JOIN track p ON p.track_id = a.track_id JOIN track q ON q.track_id = b.track_id WHERE p.supplier_role = q.supplier_role AND p.offering_family = q.offering_family AND a.track_id <> b.track_id),
r AS (SELECT x AS node, x AS reach FROM s UNION SELECT r.node, s.y FROM r JOIN s ON s.x = r.reach), c AS (SELECT node, least(min(reach), node) AS market FROM r GROUP BY node) SELECT coalesce(c.market, t.track_id) AS market, count(*) AS members, min(t.confidence) AS confidence, CASE WHEN bool_or(status = 'watchlist') THEN 'watchlist' ELSE 'candidate' END AS status FROM track t LEFT JOIN c ON c.node = t.track_id GROUP BY 1""")
def _(spark, d):
    t = T(spark, d, "track")
    m = t.select("track_id", "supplier_role", "offering_family", F.explode("topic_ids").alias("t"))
    j = m.alias("p").join(m.alias("q"), ["t", "supplier_role", "offering_family"]).where("p.track_id < q.track_id")
    found = graphs.components(j.select(F.col("p.track_id").alias("a"), F.col("q.track_id").alias("b")))
    merged = t.join(found, F.col("track_id") == F.col("node"), "left")
    return merged.groupBy(F.coalesce("component", "track_id").alias("market")).agg(F.count("*").alias("members"), F.min("confidence").alias("confidence"), F.when(F.bool_or(F.col("status") == "watchlist"), "watchlist").otherwise("candidate").alias("status"))


BM25 = r"""WITH d AS (SELECT topic_id AS id, list_transform(range(1, length(label)), lambda i: substr(label, i, 2)) || list_transform(range(1, length(label) - 1), lambda i: substr(label, i, 3)) AS grams FROM topic WHERE length(label) >= 2), q AS (SELECT track_id AS id, list_transform(range(1, length(name)), lambda i: substr(name, i, 2)) || list_transform(range(1, length(name) - 1), lambda i: substr(name, i, 3)) AS grams FROM track WHERE length(name) >= 2),
t AS (SELECT id AS doc_id, g, count(*) AS tf FROM (SELECT id, unnest(grams) AS g FROM d) GROUP BY 1, 2), l AS (SELECT id AS doc_id, len(grams) AS len FROM d), st AS (SELECT count(*) AS n, avg(len) AS mean FROM l),
i AS (SELECT g, mean, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM t, st GROUP BY g, n, mean), w AS (SELECT doc_id, g, tf, idf, mean FROM t JOIN i USING (g)), m AS (SELECT doc_id, sum(idf) AS mass FROM w GROUP BY doc_id), a AS (SELECT DISTINCT id AS query_id, unnest(grams) AS g FROM q),
h AS (SELECT query_id, doc_id, sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / mean))) AS score, sum(idf) AS hit, count(*) FILTER (WHERE idf >= 1.5) AS matched_rare FROM a JOIN w USING (g) JOIN l USING (doc_id) GROUP BY 1, 2), s AS (SELECT query_id, doc_id, score, hit / mass AS coverage, matched_rare FROM h JOIN m USING (doc_id))"""


def _bm25(spark, d) -> tuple[DataFrame, int]:
    """Scores of the pairs of tracks and topics with a gram in common, and the number of all pairs."""
    docs = T(spark, d, "topic").where("length(label) >= 2").select(F.col("topic_id").alias("id"), X.all_grams(F.col("label")).alias("grams"))
    asked = T(spark, d, "track").where("length(name) >= 2").select(F.col("track_id").alias("id"), X.all_grams(F.col("name")).alias("grams"))
    return retrieval.bm25(docs, asked), docs.count() * asked.count()


@Q("g15_bm25_pairs", "G15 F20", BM25 + " SELECT query_id, doc_id, round(score, 4) AS score, round(coverage, 4) AS coverage, matched_rare FROM s")
def _(spark, d):
    return _bm25(spark, d)[0].select("query_id", "doc_id", F.round("score", 4).alias("score"), F.round("coverage", 4).alias("coverage"), "matched_rare")


@Q("g16_hybrid_topk", "F25 F26 L4", BM25 + """, z AS (SELECT coalesce(score, 0) AS score, coalesce(coverage, 0) AS coverage FROM (SELECT q.id AS query_id, d.id AS doc_id FROM q, d) LEFT JOIN s USING (query_id, doc_id)),
k AS (SELECT quantile_cont(score, 0.25) l25, quantile_cont(score, 0.5) l50, quantile_cont(score, 0.75) l75, quantile_cont(coverage, 0.25) s25, quantile_cont(coverage, 0.5) s50, quantile_cont(coverage, 0.75) s75 FROM z),
f AS (SELECT query_id, doc_id, round(0.6 / (1 + exp(-greatest(-12, least(12, (coverage - s50) / greatest((s75 - s25) / 1.349, 1e-8))))) + 0.4 / (1 + exp(-greatest(-12, least(12, (score - l50) / greatest((l75 - l25) / 1.349, 1e-8))))), 3) AS hybrid FROM s, k),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hybrid DESC, doc_id) AS rank FROM f) SELECT query_id, doc_id, hybrid, rank FROM r WHERE rank <= 5""")
def _(spark, d):
    pairs, every = _bm25(spark, d)
    f = retrieval.fused(pairs, "score", "coverage", 0.6, every).withColumn("hybrid", F.round("hybrid", 3))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("hybrid"), "doc_id")).cast("bigint")
    return f.select("query_id", "doc_id", "hybrid", rank.alias("rank")).where("rank <= 5")


@Q("j13_verbatim_evidence", "J13 F9 F10", r"""SELECT DISTINCT p.page_id AS quote_id, CASE WHEN instr(p.extracted_text, s.snippet) > 0 AND s.snippet <> '' THEN 'exact' WHEN contains(lower(regexp_replace(regexp_replace(p.extracted_text, '\^?\[\d+\]\^?', '', 'g'), '[^\p{L}\p{N}]', '', 'g')), lower(regexp_replace(regexp_replace(s.snippet, '\^?\[\d+\]\^?', '', 'g'), '[^\p{L}\p{N}]', '', 'g'))) AND regexp_matches(regexp_replace(s.snippet, '\^?\[\d+\]\^?', '', 'g'), '[\p{L}\p{N}]') THEN 'normalised' END AS form
FROM remote_page_result p JOIN (SELECT DISTINCT result_id, snippet FROM search_result WHERE snippet IS NOT NULL) s ON s.result_id = p.result_id""")
def _(spark, d):
    pages = T(spark, d, "remote_page_result").select("page_id", "result_id", F.col("extracted_text").alias("text")).dropDuplicates(["page_id"])
    snippets = T(spark, d, "search_result").where("snippet is not null").select("result_id", F.col("snippet").alias("quote")).distinct()
    quotes = pages.select(F.col("page_id").alias("quote_id"), "result_id", "page_id").join(snippets, "result_id").select("quote_id", "page_id", "quote")
    return evidence.matched(pages.select("page_id", "text"), quotes, "page_id").select("quote_id", "form").distinct()


@Q("g09_evidence_strength", "G9 A21")
def _(spark, d):
    r = T(spark, d, "search_result").where("task_id is not null").dropDuplicates(["result_id"])
    facts = r.select(
        "task_id", F.col("result_id").alias("fact_id"), F.md5(F.coalesce("title", F.lit(""))).alias("fingerprint"), F.md5(F.coalesce("snippet", F.lit(""))).alias("quote_hash"), X.canonical_url(F.col("url")).alias("document"),
        X.host(F.col("url")).rlike(r"(^|\.)gov\.").alias("authoritative"), F.lit(0.8).alias("confidence"), F.coalesce(F.length("snippet") >= 20, F.lit(False)).alias("has_quote"),
    )
    return evidence.strength(facts, "task_id")
