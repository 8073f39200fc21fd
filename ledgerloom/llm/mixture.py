"""Mixing of sources to target shares of the total size in tokens.

Within a source documents are ordered by Efraimidis-Spirakis keys u^(1/weight), largest first. The source's budget
is spent on complete passes over it first; the rest goes to the documents with the largest keys until the
prefix sum of sizes reaches it. Prefix sums run over bins of keys; only the bin in which a budget ends is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Documents of a source in a bin on average.
BIN_ROWS = 20_000


def quality(text: Column) -> Column:
    """Share of letters and digits in a text, 0.05 at least."""
    return F.greatest(F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", "")) / F.greatest(F.length(text), F.lit(1)), F.lit(0.05))


def plan_budgets(docs: DataFrame, targets: DataFrame, total: int | None) -> DataFrame:
    """Per source of targets: what it holds, its budget, complete passes, and the tokens left for the fractional pass.

    Without a total it is the largest for which every source that has documents reaches its share within its repeats.
    A source without documents has budget 0. Few rows: one for each target.
    """
    held = docs.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("held_tokens"), F.count("*").alias("held_docs"))
    wanted = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    plan = wanted.join(held, "source", "left").na.fill(0, ["held_tokens", "held_docs"])
    room = F.col("held_tokens") * F.col("max_repeats")
    if total is None:
        reach = plan.where("held_tokens > 0 and target_share > 0").agg(F.floor(F.min(room / F.col("target_share"))).cast("bigint").alias("total"))
        plan = plan.join(reach, how="left")
    else:
        plan = plan.withColumn("total", F.lit(total).cast("bigint"))
    budget = F.least(F.round(F.col("target_share") * F.col("total")).cast("bigint"), room)
    plan = plan.withColumn("budget", F.coalesce(budget, F.lit(0)))
    passes = F.when(F.col("held_tokens") > 0, F.floor(F.col("budget") / F.col("held_tokens"))).otherwise(0).cast("int")
    return plan.withColumn("passes", passes).withColumn("rest", F.col("budget") - F.col("passes") * F.col("held_tokens"))


def mix(docs: DataFrame, plan: DataFrame, rows: int, seed: int = 17) -> DataFrame:
    """(doc_id, source, n_tokens, copies): how often each document comes in the mixture; documents that do not come have no row.

    docs holds doc_id, source, n_tokens and weight. Documents without tokens, or of sources without a target, never
    come. Equal keys are ordered by doc_id, so the result is the same each time.
    """
    bins = max(16, min(1 << 20, rows // BIN_ROWS))
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.05)
    keyed = docs.where("n_tokens > 0").withColumn("key", F.pow(u, 1 / weight)).withColumn("bin", F.floor(F.col("key") * bins).cast("int"))
    ahead = Window.partitionBy("source").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy("source", "bin").agg(F.sum("n_tokens").alias("in_bin"))
    sums = sums.withColumn("before", F.coalesce(F.sum("in_bin").over(ahead), F.lit(0))).join(plan.select("source", "passes", "rest"), "source")
    left = F.col("rest") - F.col("before")
    sums = sums.select("source", "bin", "passes", left.alias("left"), F.when(left >= F.col("in_bin"), 1).when(left <= 0, 0).alias("whole"))
    placed = keyed.join(sums, ["source", "bin"])
    decided = placed.where("whole is not null").select("doc_id", "source", "n_tokens", (F.col("passes") + F.col("whole")).alias("copies"))
    running = F.sum("n_tokens").over(Window.partitionBy("source", "bin").orderBy(F.desc("key"), "doc_id"))
    edge = placed.where("whole is null").withColumn("taken", (running <= F.col("left")).cast("int"))
    edge = edge.select("doc_id", "source", "n_tokens", (F.col("passes") + F.col("taken")).alias("copies"))
    return decided.unionByName(edge).where("copies > 0")


def report(plan: DataFrame, mixture: DataFrame) -> DataFrame:
    """Per target source: its target, what it holds, and what it contributes; actual_share is of the whole mixture."""
    got = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").cast("int").alias("most_copies"))
    whole = got.agg(F.sum("mixed_tokens").alias("all_tokens"))
    out = plan.join(got, "source", "left").join(whole, how="left").na.fill(0, ["mixed_tokens", "most_copies"])
    share = F.coalesce(F.col("mixed_tokens") / F.col("all_tokens"), F.lit(0.0))
    return out.select("source", "target_share", "max_repeats", "held_tokens", "budget", "mixed_tokens", F.round(share, 6).alias("actual_share"), "most_copies")
