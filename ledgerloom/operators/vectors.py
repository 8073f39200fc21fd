"""Vector expressions and role-blocked similarity edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Scalar product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column, floor: float = 1e-12) -> Column:
    return dot(a, b) / (F.greatest(F.sqrt(dot(a, a)), F.lit(floor)) * F.greatest(F.sqrt(dot(b, b)), F.lit(floor)))


def unit(v: Column, floor: float = 1e-12) -> Column:
    norm = F.greatest(F.sqrt(dot(v, v)), F.lit(floor))
    return F.transform(v, lambda x: x.cast("double") / norm)


def blocked_pairs(vectors: DataFrame, role: str, least: float) -> DataFrame:
    """(role, a, b, similarity) for pairs a < b of (id, role, vec) of one role that are at least least similar.

    The role is an equi-key, so pairs are formed inside roles only; norms are taken once per vector.
    """
    v = vectors.select("id", role, unit(F.col("vec")).alias("u"))
    a, b = v.alias("x"), v.alias("y")
    s = F.round(dot(F.col("x.u"), F.col("y.u")), 6)
    j = a.join(b, (F.col(f"x.{role}") == F.col(f"y.{role}")) & (F.col("x.id") < F.col("y.id")))
    return j.select(F.col(f"x.{role}").alias(role), F.col("x.id").alias("a"), F.col("y.id").alias("b"), s.alias("similarity")).where(F.col("similarity") >= least)


def symmetric(edges: DataFrame) -> DataFrame:
    """(src, dst, similarity) both ways, the largest similarity of each."""
    e = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), "similarity")
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "similarity"))
    return both.groupBy("src", "dst").agg(F.max("similarity").alias("similarity"))


def top_neighbours(directed: DataFrame, k: int, margin: float) -> DataFrame:
    """The k best neighbours of each node that are within margin of its best one; ties by id."""
    w = Window.partitionBy("src").orderBy(F.desc("similarity"), "dst")
    best = F.max("similarity").over(Window.partitionBy("src"))
    return directed.withColumns({"rank": F.row_number().over(w), "best": best}).where((F.col("rank") <= k) & (F.col("similarity") >= F.col("best") - margin)).select("src", "dst", "similarity")


def strength(similarity: Column, floor: float) -> Column:
    """How far a similarity stands above the floor, from 0 to 1."""
    return (similarity - floor) / F.greatest(F.lit(1.0 - floor), F.lit(1e-6))
