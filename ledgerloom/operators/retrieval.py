"""Lexical and hybrid retrieval: BM25 over character grams, robust scaling and fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bm25(docs: DataFrame, queries: DataFrame, k1: float = 1.5, b: float = 0.75, rare: float = 1.5) -> DataFrame:
    """(query_id, doc_id, score, coverage, matched_rare) of (id, grams) tables, for pairs with a gram in common.

    The query is a set; a document's grams count as often as they come. The join runs over grams: pairs without a common
    gram have score, coverage and matched_rare 0 and no row. Coverage is the idf of matched grams over that of the
    document's distinct ones; matched_rare counts matched grams with an idf of at least rare.
    """
    terms = docs.select(F.col("id").alias("doc_id"), F.explode("grams").alias("g")).groupBy("doc_id", "g").agg(F.count("*").alias("tf"))
    lengths = docs.select(F.col("id").alias("doc_id"), F.size("grams").alias("len"))
    stats = lengths.agg(F.count("*").alias("n"), F.avg("len").alias("mean"))
    idf = terms.groupBy("g").agg(F.count("*").alias("df")).crossJoin(F.broadcast(stats))  # one row
    idf = idf.select("g", "mean", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    weighted = terms.join(idf, "g")
    mass = weighted.groupBy("doc_id").agg(F.sum("idf").alias("mass"))
    asked = queries.select(F.col("id").alias("query_id"), F.explode(F.array_distinct("grams")).alias("g"))
    weight = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("mean")))
    hits = asked.join(weighted, "g").join(lengths, "doc_id").groupBy("query_id", "doc_id")
    hits = hits.agg(F.sum(weight).alias("score"), F.sum("idf").alias("hit"), F.sum((F.col("idf") >= rare).cast("int")).alias("matched_rare"))
    return hits.join(mass, "doc_id").select("query_id", "doc_id", "score", (F.col("hit") / F.col("mass")).alias("coverage"), "matched_rare")


def robust_sigmoid(x: Column, median: Column, iqr: Column) -> Column:
    """x scaled by median and interquartile range, clipped at 12, through the logistic function."""
    z = (x - median) / F.greatest(iqr / 1.349, F.lit(1e-8))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))))


def fused(pairs: DataFrame, lexical: str, semantic: str, weight: float, all_pairs: Column | int | None = None) -> DataFrame:
    """pairs with hybrid: weight times the scaled semantic score and the rest the scaled lexical one.

    all_pairs is the number of pairs there are; those without a row count as zeros in the statistics.
    """
    held = pairs.select(lexical, semantic, F.lit(1).cast("bigint").alias("times"))
    if all_pairs is not None:
        zero = pairs.agg(F.lit(0.0).alias(lexical), F.lit(0.0).alias(semantic), (F.lit(all_pairs) - F.count("*")).cast("bigint").alias("times"))
        held = held.unionByName(zero)
    q = lambda c, p: F.percentile(c, F.lit(p), F.col("times"))
    stats = held.agg(*[q(c, p).alias(f"{n}{i}") for c, n in ((lexical, "l"), (semantic, "s")) for i, p in ((25, 0.25), (50, 0.5), (75, 0.75))])
    p = pairs.crossJoin(F.broadcast(stats))  # one row
    s = robust_sigmoid(F.col(semantic), F.col("s50"), F.col("s75") - F.col("s25"))
    l = robust_sigmoid(F.col(lexical), F.col("l50"), F.col("l75") - F.col("l25"))
    return p.withColumn("hybrid", weight * s + (1 - weight) * l).drop("l25", "l50", "l75", "s25", "s50", "s75")


def tf_idf(terms: DataFrame) -> DataFrame:
    """(id, term, weight) of (id, term) rows: (1 + ln tf) times ln((N + 1) / (df + 1)); N counts the ids that have a term."""
    tf = terms.where("term is not null").groupBy("id", "term").agg(F.count("*").alias("tf"))
    n = tf.select("id").distinct().agg(F.count("*").alias("n"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    weight = (1 + F.log("tf")) * F.log((F.col("n") + 1) / (F.col("df") + 1))
    return tf.join(df, "term").crossJoin(F.broadcast(n)).select("id", "term", weight.alias("weight"))  # one row
