"""Readers beside Parquet: company sheets, JSON catalogues, pipe tables and embedded payloads."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def company_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its suffix: parquet, csv (UTF-8, with or without mark) or xlsx; any other suffix is an error."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "csv":
        df = spark.read.csv(path, header=True, multiLine=True, escape='"')
        return df.toDF(*[c.lstrip("﻿") for c in df.columns])
    if suffix == "xlsx":
        spark.dataSource.register(XlsxSource)
        return spark.read.format("xlsx").load(path)
    raise ValueError(f"unknown table suffix: {suffix}")


def catalogue(spark: SparkSession, path: str, field: str = "tracks") -> DataFrame:
    """Records of a JSON array, of {field: [...]}, or of JSON lines."""
    df = spark.read.json(path, multiLine=not path.endswith("l"))
    return df.select(F.explode(field).alias("r")).select("r.*") if field in df.columns else df


def pipe_table(spark: SparkSession, path: str, columns: list[str], prefix: str = "P") -> DataFrame:
    """Rows of a Markdown pipe table with exactly as many cells as columns; the first such row is the header, separator rows are skipped; ids are numbered in row order.

    The row order of one small document is a total order, so numbering runs in one task.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("row", "line")).where("trim(line) like '|%|'")
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = lines.select("row", cells.alias("c")).where((F.size("c") == len(columns)) & ~F.forall("c", lambda x: x.rlike(r"^:?-+:?$")))
    numbered = rows.withColumn("n", F.row_number().over(Window.orderBy("row"))).where("n > 1")
    return numbered.select(F.format_string(prefix + "%03d", (F.col("n") - 1).cast("int")).alias("id"), *[F.col("c")[i].alias(c) for i, c in enumerate(columns)])


def embedded_json(spark: SparkSession, path: str, pattern: str, schema: str) -> DataFrame:
    """The JSON payload that a pattern's first group finds in each file, parsed by a schema; files without one give no row."""
    text = spark.read.text(path, wholetext=True)
    found = F.regexp_extract("value", f"(?s){pattern}", 1)
    return text.where(found != "").select(F.from_json(F.replace(found, F.lit("<\\/"), F.lit("</")), schema).alias("payload"))


def _sheet(path: str) -> list[list[str | None]]:
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with open(path.removeprefix("file:"), "rb") as f, zipfile.ZipFile(io.BytesIO(f.read())) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{{{ns['m']}}}t")) for s in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        name = min(n for n in z.namelist() if re.match(r"xl/worksheets/sheet\d+\.xml$", n))
        rows = []
        for row in ET.fromstring(z.read(name)).iter(f"{{{ns['m']}}}row"):
            cells: dict[int, str | None] = {}
            for c in row.findall("m:c", ns):
                at = 0
                for ch in re.match(r"[A-Z]+", c.get("r", "A")).group(0):
                    at = at * 26 + ord(ch) - 64
                v = c.find("m:v", ns)
                inline = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t"))
                cells[at - 1] = shared[int(v.text)] if c.get("t") == "s" and v is not None else inline or (v.text if v is not None else None)
            if any(x not in (None, "") for x in cells.values()):
                rows.append([cells.get(i) for i in range(max(cells) + 1)])
    return rows


class XlsxSource(DataSource):
    """First sheet of a workbook as strings; the first row names the columns, blank rows are dropped."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in _sheet(self.options["path"])[0])

    def reader(self, schema) -> DataSourceReader:
        return _XlsxReader(self.options["path"], len(schema))


class _XlsxReader(DataSourceReader):
    def __init__(self, path: str, width: int) -> None:
        self.path, self.width = path, width

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for row in _sheet(self.path)[1:]:
            yield tuple((row + [None] * self.width)[: self.width])


def html_pages(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, title, published, text) of HTML: boilerplate elements away, article before main before body; null and empty give empty text."""
    from html.parser import HTMLParser

    skipped = {"script", "style", "noscript", "svg", "iframe", "form", "nav", "footer", "header", "aside"}
    block = {"p", "div", "li", "h1", "h2", "h3", "h4", "br", "tr", "section", "article", "main", "body", "title", "ul"}

    class Reader(HTMLParser):
        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.stack: list[str] = []
            self.parts: dict[str, list[str]] = {"article": [], "main": [], "body": [], "title": []}
            self.published = None

        def handle_starttag(self, tag, attrs):
            a = dict(attrs)
            if tag == "meta" and (a.get("property") or a.get("name") or "").lower() in ("article:published_time", "publishdate", "pubdate", "date") and not self.published:
                self.published = a.get("content")
            if tag == "time" and not self.published:
                self.published = a.get("datetime")
            if tag in block:
                self.put("\n")
            if tag not in ("meta", "br", "img", "link", "input", "hr"):
                self.stack.append(tag)

        def handle_endtag(self, tag):
            if tag in block:
                self.put("\n")
            while self.stack and tag in self.stack and self.stack.pop() != tag:
                pass

        def put(self, text):
            if skipped & set(self.stack):
                return
            for name in self.parts:
                if name in self.stack or name == "body" and "title" not in self.stack and "head" not in self.stack:
                    self.parts[name].append(text)

        def handle_data(self, data):
            self.put(data)

    @F.pandas_udf("title string, published string, text string")
    def read(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for raw in part:
                r = Reader()
                r.feed(raw or "")
                text = next((t for n in ("article", "main", "body") if (t := "".join(r.parts[n])).strip()), "")
                lines = [re.sub(r"[ \t ]+", " ", x).strip() for x in text.split("\n")]
                rows.append(("".join(r.parts["title"]).strip() or None, r.published, "\n".join(x for x in lines if x)))
            yield pd.DataFrame(rows, columns=["title", "published", "text"])

    return df.select(key, read(html).alias("r")).select(key, "r.*")
