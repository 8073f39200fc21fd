"""Writers: the Parquet, JSON and CSV triple, a dashboard page, and an append-only event log."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def flat(df: DataFrame, sep: str = ";") -> DataFrame:
    """Lists of strings joined, other nested columns as JSON, for formats without nesting."""

    def one(f) -> Column:
        if isinstance(f.dataType, ArrayType) and f.dataType.elementType.simpleString() == "string":
            return F.array_join(f.name, sep).alias(f.name)
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            return F.to_json(f.name).alias(f.name)
        return F.col(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def write_rows(df: DataFrame, stem: str) -> bool:
    """stem.parquet, stem.jsonl and stem.csv, each written in parallel; an empty input writes nothing and gives False."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{stem}.parquet")
    df.write.mode("overwrite").json(f"{stem}.jsonl")
    flat(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{stem}.csv")
    return True


def dashboard(tables: dict[str, DataFrame], template: str, most_rows: int = 10_000) -> str:
    """An HTML page whose template's {{payload}} is the tables' JSON, safe inside a script element.

    A page is for reading: a table of more than most_rows rows is an error, never cut.
    """
    payload = {}
    for name, df in tables.items():
        rows = df.limit(most_rows + 1).toJSON().collect()
        if len(rows) > most_rows:
            raise ValueError(f"{name} has more than {most_rows} rows")
        payload[name] = [json.loads(r) for r in rows]
    return template.replace("{{payload}}", json.dumps(payload, ensure_ascii=False).replace("</", "<\\/"))


def append_events(df: DataFrame, path: str) -> None:
    """Rows appended to a log, one folder per day of ts."""
    df.withColumn("day", F.to_date("ts")).write.mode("append").partitionBy("day").parquet(path)
