"""Evidence: verbatim matching of quotes and the greedy strength score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import evidence_form


def matched(texts: DataFrame, quotes: DataFrame, key: str) -> DataFrame:
    """(quote_id, matched, form): whether a quote (quote_id, key, quote) stands in the text (key, text) of its key.

    exact first, then letters and digits only; the offset is that of the first exact occurrence, from 1. Null quotes and texts never match.
    """
    j = quotes.join(texts, key, "left")
    exact = F.coalesce(F.expr("instr(text, quote)"), F.lit(0))
    loose = F.coalesce(F.contains(evidence_form(F.col("text")), evidence_form(F.col("quote"))) & (evidence_form(F.col("quote")) != ""), F.lit(False))
    form = F.when((F.col("quote") != "") & (exact > 0), "exact").when(loose, "normalised")
    return j.select("quote_id", form.isNotNull().alias("matched"), form.alias("form"), F.when(form == "exact", exact).alias("offset"))


def strength(facts: DataFrame, key: str, least_confidence: float = 0.7) -> DataFrame:
    """(key, picks, status) of facts (key, fact_id, fingerprint, quote_hash, document, authoritative, confidence, has_quote).

    Facts with a quote and enough confidence are picked greedily, authoritative ones first, if their fingerprint, quote and
    document are all new. A key is candidate with one authoritative pick or two picks, else watchlist. The order
    matters, so the facts of a key are walked in Python; keys are spread over tasks.
    """

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["authoritative", "confidence", "fact_id"], ascending=[False, False, True])
        seen: set = set()
        picks = strong = 0
        for r in rows.itertuples():
            marks = {("f", r.fingerprint), ("q", r.quote_hash), ("d", r.document)}
            if not r.has_quote or not r.confidence >= least_confidence or marks & seen:
                continue
            seen |= marks
            picks += 1
            strong += bool(r.authoritative)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "picks": [picks], "status": ["candidate" if strong or picks >= 2 else "watchlist"]})

    kind = facts.schema[key].dataType.simpleString()
    return facts.groupBy(key).applyInPandas(walk, f"{key} {kind}, picks bigint, status string")


def representatives(rows: DataFrame, key: str, kind: str, title: str, order: str) -> DataFrame:
    """The rows of each key that stand for it, at most two, with their pick number.

    The first is the first by kind (nulls last), then order. The second is the next in that order whose kind and title
    are both new, or else the first by order alone whose title is new. Aggregates only: no key is one task's.
    """
    row = F.struct(*[F.col(c) for c in rows.columns])
    by_kind = [F.col(kind).isNull(), F.col(kind), F.col(order)]
    first = rows.groupBy(key).agg(F.min_by(row, F.struct(*by_kind)).alias("_row"))
    lead = first.select(key, F.col(f"_row.{kind}").alias("_kind"), F.col(f"_row.{title}").alias("_title"))
    other = rows.join(lead, key).where(~F.col(title).eqNullSafe(F.col("_title")))
    new_kind = ~F.col(kind).eqNullSafe(F.col("_kind"))
    rank = F.struct((~new_kind).alias("a"), F.when(new_kind, F.col(kind).isNull()).alias("b"), F.when(new_kind, F.col(kind)).alias("c"), F.col(order).alias("d"))
    second = other.groupBy(key).agg(F.min_by(row, rank).alias("_row"))
    return first.select("_row.*", F.lit(1).cast("bigint").alias("pick")).unionByName(second.select("_row.*", F.lit(2).cast("bigint").alias("pick")))


def located(texts: DataFrame, quotes: DataFrame, key: str, least: int = 8) -> DataFrame:
    """(quote_id, part, start, found): where the parts of quotes (quote_id, key, quote) stand in the text (key, text) of their key.

    A quote that leaves something out (... or …) is cut there, and each part of at least least letters and digits is sought;
    a whole quote is part 1. An exact occurrence goes before one that agrees in letters and digits only, without citation
    marks and case; found is the text as it stands there, start counts from 1. Parts that are not found, null texts and null quotes have no row.
    """

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = re.compile(r"\^?\[\d+\]\^?")

        def letters(text: str) -> tuple[str, list[int]]:
            signs, places, at = [], [], 0
            for m in [*mark.finditer(text), None]:
                for i in range(at, m.start() if m else len(text)):
                    if text[i].isalnum():
                        low = text[i].lower()
                        signs.append(low)
                        places += [i] * len(low)
                at = m.end() if m else at
            return "".join(signs), places

        for b in batches:
            out: list[tuple] = []
            for quote_id, text, quote in zip(*(b.column(c).to_pylist() for c in ("quote_id", "text", "quote")), strict=True):
                parts = [p.strip() for p in re.split(r"\.{3}|…+", quote)]
                whole = len(parts) == 1
                body = None
                for n, part in enumerate([quote] if whole else parts, 1):
                    form = letters(part)[0]
                    if not form or not whole and len(form) < least:
                        continue
                    at = text.find(part)
                    if at >= 0:
                        out.append((quote_id, n, at + 1, part))
                        continue
                    body = body or letters(text)
                    at = body[0].find(form)
                    if at >= 0:
                        start, end = body[1][at], body[1][at + len(form) - 1] + 1
                        out.append((quote_id, n, start + 1, text[start:end]))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["quote_id", "part", "start", "found"])

    pairs = quotes.where("quote is not null").join(texts.where("text is not null"), key).select(F.col("quote_id").cast("bigint"), "text", "quote")
    return pairs.mapInArrow(seek, "quote_id bigint, part int, start bigint, found string")
