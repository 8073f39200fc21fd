"""Table access and session-level storage settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share, as the cluster names it in spark.checkpoint.dir.

    A folder of this machine is used only where the setting is absent, as in tests with a local master.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    own = os.path.join(tempfile.gettempdir(), f"ledgerloom-{sc.applicationId}")
    os.makedirs(own, exist_ok=True)
    return "file://" + own


#: Tables written by this driver.
_WRITTEN: list[str] = []


def release(spark: SparkSession) -> int:
    """Deletes the tables that materialise has written for this driver, and gives their number.

    To be called when the results that read them are done; a result that is read after that fails.
    """
    jvm = spark.sparkContext._jvm
    conf, n = spark.sparkContext._jsc.hadoopConfiguration(), len(_WRITTEN)
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)
    return n


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut the lineage of df with a Parquet table in the shared folder and read it back.

    The table outlives any executor, so a later stage never recomputes what went into it.
    """
    path = f"{shared_dir(df.sparkSession)}/ledgerloom/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
