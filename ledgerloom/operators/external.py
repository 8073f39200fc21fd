"""Contract of model and network calls: a function over batches, checked against the references it was given.

The function is the only part that leaves the engine; a recorded or deterministic one makes every run repeatable.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import accounting, insert_missing


def call(requests: DataFrame, cached: DataFrame, key: str, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Answers of all requests: cached ones by key, the rest from fn, batch by batch. cached has the columns of schema."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield fn(batch)

    fresh = insert_missing(cached, requests, [key]).mapInPandas(run, schema)
    return cached.join(requests.select(key).distinct(), key, "left_semi").unionByName(fresh)


def checked(requests: DataFrame, answers: DataFrame, key: str, repair: Callable[[pd.DataFrame], pd.DataFrame] | None, schema: str) -> tuple[DataFrame, DataFrame]:
    """(accepted answers, violations): each request is answered exactly once; wrong ones get one repair pass."""
    bad = accounting(requests, answers, key)
    good = answers.join(bad.select(key), key, "left_anti")
    if repair is None:
        return good, bad
    again = requests.join(bad.where("violation != 'unknown'").select(key), key, "left_semi")
    fixed = again.mapInPandas(lambda batches: (repair(b) for b in batches if len(b)), schema)
    both = good.unionByName(fixed)
    return both.join(accounting(requests, both, key).select(key), key, "left_anti"), accounting(requests, both, key)


def stub_embedding(texts: DataFrame, key: str, text: str, dim: int = 64) -> DataFrame:
    """(key, vec): deterministic vectors from hashes of character pairs, for runs without a model; null texts give zeros."""
    size = F.length(F.coalesce(text, F.lit("")))
    pairs = F.when(size >= 2, F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.pmod(F.xxhash64(F.substr(F.col(text), i, F.lit(2))), F.lit(dim)))).otherwise(F.array().cast("array<bigint>"))
    slots = F.array(*[F.lit(i) for i in range(dim)])
    return texts.withColumn("_p", pairs).select(key, F.transform(slots, lambda s: F.size(F.filter("_p", lambda p: p == s)).cast("float")).alias("vec"))
