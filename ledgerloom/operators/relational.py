"""Relational building blocks: latest rows, ordered unions, upserts, accounting and state roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_seen(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """Duplicates of key removed; the first row in the given order stays."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def ordered_union(df: DataFrame, keys: list[str], value: str, position: Column, sep: str = "|") -> DataFrame:
    """keys and values: the distinct values of each key in the order of their first position; nulls are left out.

    Map-side: distinct values are combined before the shuffle, so a key costs its distinct values only.
    """
    firsts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(position).alias("_first"))
    items = F.array_sort(F.collect_list(F.struct("_first", F.col(value).cast("string").alias("_value"))))
    return firsts.groupBy(*keys).agg(F.array_join(F.transform(items, lambda x: x["_value"]), sep).alias("values"))


def insert_missing(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose key is not in existing."""
    return new.join(existing.select(*keys).distinct(), keys, "left_anti")


def by_optional(df: DataFrame, column: str, values: list | None) -> DataFrame:
    """Rows whose column is in values; None sets no condition, an empty list finds nothing. Nulls are in no list."""
    return df if values is None else df.where(F.col(column).isin(values) if values else F.lit(False))


def promote(df: DataFrame, key: str, order: list[str], decision: str, keep: str = "keep") -> DataFrame:
    """Upsert of rows by key: the first row wins, but its decision may be promoted to keep by any later one."""
    rest = [c for c in df.columns if c not in (key, decision)]
    row = F.struct(*[F.col(c) for c in rest], F.col(decision))
    out = df.groupBy(key).agg(F.min_by(row, F.struct(*order)).alias("_row"), F.max((F.col(decision) == keep).cast("int")).alias("_kept"))
    return out.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest], F.when(F.col("_kept") == 1, keep).otherwise(F.col(f"_row.{decision}")).alias(decision))


def merge_archive(existing: DataFrame, new: DataFrame, key: str, status: str) -> DataFrame:
    """Existing rows replaced by new ones of the same key; existing rows without one get status archived."""
    gone = existing.join(new.select(key), key, "left_anti").withColumn(status, F.lit("archived"))
    return new.select(*existing.columns).unionByName(gone)


def accounting(expected: DataFrame, used: DataFrame, ref: str) -> DataFrame:
    """Violations of 'every reference is used exactly once': (ref, violation, n)."""
    counts = used.groupBy(ref).agg(F.count("*").alias("n"))
    both = expected.select(ref).distinct().withColumn("_e", F.lit(1)).join(counts, ref, "full_outer")
    kind = F.when(F.col("_e").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate")
    return both.select(ref, kind.alias("violation"), F.coalesce("n", F.lit(0)).alias("n")).where("violation is not null")


def rollup_status(df: DataFrame, key: str, status: str) -> DataFrame:
    """One state per key, by precedence: all completed, any running, any terminal, any retryable, else pending."""
    is_ = lambda s: F.bool_or(F.col(status) == s)
    state = (
        F.when(F.bool_and(F.col(status) == "completed"), "completed").when(is_("running"), "running").when(is_("failed_terminal"), "failed_terminal")
        .when(is_("failed_retryable"), "failed_retryable").otherwise("pending")
    )
    return df.groupBy(key).agg(state.alias("state"), F.count("*").alias("n"))


def budgeted(df: DataFrame, key: str, order: list[Column], budget: Column) -> DataFrame:
    """The first rows of each key in the given order, as many as its budget."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("admitted_rank", rank).where(F.col("admitted_rank") <= budget)


def stratified(df: DataFrame, stratum: str, id_col: str, n: int) -> DataFrame:
    """Round-robin sample of n rows over strata; within a stratum rows come in the order of the MD5 of their id."""
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(F.md5(F.col(id_col).cast("string"))))
    return df.withColumn("stratum_rank", rank).orderBy("stratum_rank", stratum).limit(n)


def gap_cut(df: DataFrame, node: str, score: str, order: list[Column], least: float = 0.03) -> DataFrame:
    """Neighbours of each node up to its first largest gap, if there are more than two and it exceeds max(least, median + 3 MAD)."""
    w = Window.partitionBy(node).orderBy(*order)
    gaps = df.withColumns({"_pos": F.row_number().over(w), "_gap": F.round(F.col(score) - F.lead(score).over(w), 6)})
    mid = gaps.groupBy(node).agg(F.percentile("_gap", F.lit(0.5)).alias("_median"), F.count("*").alias("_n"), F.max("_gap").alias("_top"))
    with_mid = gaps.join(mid, node)
    mad = with_mid.groupBy(node).agg(F.percentile(F.abs(F.col("_gap") - F.col("_median")), F.lit(0.5)).alias("_mad"), F.min(F.when(F.col("_gap") == F.col("_top"), F.col("_pos"))).alias("_at"))
    cut = (F.col("_n") > 2) & (F.col("_top") > F.greatest(F.lit(least), F.col("_median") + 3 * F.col("_mad")))
    return with_mid.join(mad, node).where(~F.coalesce(cut, F.lit(False)) | (F.col("_pos") <= F.col("_at"))).drop("_pos", "_gap", "_median", "_n", "_top", "_mad", "_at")
