"""The run log as a stream: windowed counts with late data, and job states with lease expiry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def log_stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream, at most files of them in a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed_counts(log: DataFrame, ts: str, kind: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, kind, n): rows by window of event time; rows later than late behind the newest are dropped."""
    timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.groupBy(F.window(ts, window), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def job_states(log: DataFrame, key: str, ts: str, status: str, most: int = 3, lease: str = "10 minutes") -> DataFrame:
    """(key, state, attempts): each job's state after its events, as rows on each change.

    running adds an attempt; a failed job is retryable until most attempts, then terminal; a running job whose lease
    passes in event time fails the same way.
    """
    millis = int(pd.Timedelta(lease).total_seconds() * 1000)
    kind = log.schema[key].dataType.simpleString()

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, attempts = state.get if state.exists else ("pending", 0)
        if state.hasTimedOut:
            if now == "running":
                now = "failed_retryable" if attempts < most else "failed_terminal"
            state.update((now, attempts))
            yield pd.DataFrame({key: [k[0]], "state": [now], "attempts": [attempts]})
            return
        last = 0
        rows = pd.concat(list(batches)).sort_values(ts)
        for t, s in zip(rows[ts], rows[status], strict=True):
            if now in ("completed", "failed_terminal"):
                break
            attempts += s == "running"
            now = ("failed_retryable" if attempts < most else "failed_terminal") if s == "failed" else s
            last = max(last, int(t.timestamp() * 1000))
        state.update((now, attempts))
        if now == "running" and last:
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + millis)
        yield pd.DataFrame({key: [k[0]], "state": [now], "attempts": [attempts]})

    timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lease)
    return timed.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, state string, attempts bigint", "state string, attempts bigint", "update", GroupStateTimeout.EventTimeTimeout)
