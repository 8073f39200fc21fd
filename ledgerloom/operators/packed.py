"""Fields that hold several values: one value per row, with its position."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\s  -​　﻿]"
#: Separators between values, longest first.
DELIMITER = rf"{BLANK}*(?:<br\s*/?>|\|\||[|｜,，、;；/\t\n]){BLANK}*"
# A quote encloses only if it opens at the start of a piece and closes at its end; a doubled quote inside is an escape.
_SPAN = r"(?:\"(?:[^\"\\]|\\.|\"\")*\"|'(?:[^'\\]|\\.|'')*'|“[^“”]*”|「[^「」]*」)"
QUOTED = rf"(?<=^|[|｜,，、;；/\t\n>\s\ufeff]){_SPAN}(?={BLANK}*(?:<br|[|｜,，、;；/\t\n]|$))"
LITERAL = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""
OPEN, CLOSE, ESCAPE = "", "", ""


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def masked(cell: Column) -> tuple[Column, Column]:
    """The cell with each quoted span replaced by an indexed placeholder, and the spans without their quotes.

    Placeholder signs that the cell itself holds are escaped first, so no text can be taken for a placeholder.
    """
    safe = F.replace(F.replace(cell, F.lit(ESCAPE), F.lit(ESCAPE + "b")), F.lit(OPEN), F.lit(ESCAPE + "a"))
    rest = F.split(safe, QUOTED, -1)
    marked = F.array_join(
        F.transform(rest, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit(OPEN), (i - 1).cast("string"), F.lit(CLOSE), x))), ""
    )
    def bare(s: Column) -> Column:
        quote = F.substr(s, F.lit(1), F.lit(1))
        inner = F.replace(F.substr(s, F.lit(2), F.length(s) - 2), F.concat(quote, quote), quote)
        return F.regexp_replace(inner, r"\\([\"'\\])", "$1")

    spans = F.transform(F.regexp_extract_all(safe, F.lit(QUOTED), F.lit(0)), bare)
    return marked, spans


def restored(piece: Column, spans: Column) -> Column:
    """A piece with its placeholders replaced by their spans, by array lookup."""
    parts = F.split(piece, OPEN, -1)

    def one(part: Column, i: Column) -> Column:
        at = F.split_part(part, F.lit(CLOSE), F.lit(1)).try_cast("int")
        tail = F.substr(part, F.instr(part, CLOSE) + 1)
        return F.when(i == 0, part).otherwise(F.concat(F.get(spans, at), tail))

    text = F.array_join(F.transform(parts, one), "")
    return F.replace(F.replace(text, F.lit(ESCAPE + "a"), F.lit(OPEN)), F.lit(ESCAPE + "b"), F.lit(ESCAPE))


def readings(tokens: list[str], delims: list[str], known: set[tuple[int, int]], expected: int | None) -> list[tuple[int, int]]:
    """The pieces [i, j] of the best reading of a cell.

    A reading takes some kinds of separator as separators and the rest as text. Pieces parted by a taken
    separator are put together again only to a catalogue value. Best is: as many values as expected (if
    given), then fewest unknown values with separator signs in them, fewest unknown values, fewest kinds
    of separator, fewest values put together, most values. One rule holds for cells of any length: states keep
    their cost and where they come from, and the number of values is part of a state only if one is expected.
    """
    n = len(tokens)
    if n == 1:
        return [(0, 0)] if tokens[0] else []
    kinds = sorted(set(delims))
    blank = [not t for t in tokens]
    longer: dict[int, list[int]] = {}
    for i, j in known:
        if j > i:
            longer.setdefault(i, []).append(j)
    plain = [(i, i) for i in range(n) if not blank[i]]
    if len(kinds) == 1 and not longer and (expected is None or expected == len(plain)):
        return plain
    filled = list(accumulate((not x for x in blank), initial=0))

    def best_for(mask: int, wanted: int | None) -> tuple[tuple, list[tuple[int, int]]] | None:
        """(cost, pieces) of the best reading with these kinds of separator, of wanted values if that is given."""
        ends = [i for i in range(n) if i == n - 1 or mask >> place[delims[i]] & 1]
        atom = {j: a for a, j in enumerate(ends)}
        steps: list[list[tuple]] = []
        for a in range(len(ends)):
            i, end = (ends[a - 1] + 1 if a else 0), ends[a]
            is_known = (i, end) in known
            if filled[end + 1] == filled[i]:
                to_next = [(a + 1, 0, 0, 0, 0, None)]
            else:
                to_next = [(a + 1, int(not is_known and end > i), int(not is_known), 0, 1, (i, end))]
            for j in longer.get(i, ()):
                if j > end and j in atom:
                    to_next.append((atom[j] + 1, 0, 0, atom[j] - a, 1, (i, j)))
            steps.append(to_next)
        left = [0] * (len(ends) + 1)  # values at most from an atom on
        for a in range(len(ends) - 1, -1, -1):
            left[a] = max(x[4] + left[x[0]] for x in steps[a])
        # states: number of values, or 0 if none is wanted -> (cost, atom before, state before, piece)
        states: list[dict[int, tuple]] = [{} for _ in range(len(ends) + 1)]
        states[0][0] = ((0, 0, 0, 0), None, None, None)
        for a in range(len(ends)):
            for state, (cost, *_) in states[a].items():
                for to, marked, unknown, joined, more, piece in steps[a]:
                    new = (cost[0] + marked, cost[1] + unknown, cost[2] + joined, cost[3] - more)
                    key = 0 if wanted is None else state + more
                    if wanted is not None and not key <= wanted <= key + left[to]:
                        continue
                    old = states[to].get(key)
                    if old is None or new < old[0]:
                        states[to][key] = (new, a, state, piece)
        if not states[-1]:
            return None
        at, key = len(ends), wanted or 0
        cost, pieces = states[at][key][0], []
        while at:
            _, at, key, piece = states[at][key]
            if piece:
                pieces.append(piece)
        return cost, pieces[::-1]

    place = {k: b for b, k in enumerate(kinds)}
    for wanted in [None] if expected is None else [expected, None]:
        best = None
        for mask in range(1 << len(kinds)):
            got = best_for(mask, wanted)
            if got:
                cost = got[0]
                rank = (cost[0], cost[1], max(0, mask.bit_count() - 1), cost[2], cost[3])
                if best is None or rank < best[0]:
                    best = (rank, got[1])
        if best:
            break
    return best[1]


def explode_packed(df: DataFrame, key: str, fields: dict[str, str | None], catalogues: dict[str, DataFrame], count: str | None) -> DataFrame:
    """One row per value: key, field_name, pos (from 1, blank values not counted), value.

    fields maps a packed column to the name of its catalogue in catalogues (a DataFrame with one string column) or
    to a pattern that its values match ("re:..."), or None. count names the column with the expected number of
    values; it is used for the fields whose name starts with "topic_". Null, empty and blank cells give no
    row; a cell without separators is one value; repeated values stay; other columns of df are ignored.

    Quoted spans become indexed placeholders, the rest is split at every separator sign, and the runs of as many pieces
    as some catalogue value has are looked up in the catalogue by a join. Only the choice between readings of one cell
    (bounded by that cell) runs in Python, in Arrow batches.
    """
    names = list(fields)
    cells = df.select(
        F.col(key).alias("_key"),
        (F.col(count).cast("int") if count else F.lit(None).cast("int")).alias("_count"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("cell")) for f in names])).alias("_c"),
    ).select("_key", F.when(F.col("_c.field_name").startswith("topic_"), F.col("_count")).alias("_count"), "_c.field_name", trimmed(F.col("_c.cell")).alias("cell"))
    cells = cells.where(F.col("cell") != "")
    listed = F.col("cell").startswith("[") & F.col("cell").endswith("]")
    json = F.when(listed, F.from_json("cell", "array<string>"))
    python = F.when(
        listed & F.col("cell").rlike(rf"^\[{BLANK}*(?:(?:{LITERAL}){BLANK}*,?{BLANK}*)*\]$"),
        F.transform(
            F.regexp_extract_all("cell", F.lit(LITERAL), F.lit(0)),
            lambda s: F.regexp_replace(F.substr(s, F.lit(2), F.length(s) - 2), r"\\(.)", "$1"),
        ),
    )
    mask, spans = masked(F.col("cell"))
    cells = cells.withColumn("_list", F.coalesce(json, python))
    lists = cells.where(F.col("_list").isNotNull()).select("_key", "field_name", F.col("_list").alias("_values"))
    rest = cells.where(F.col("_list").isNull()).withColumns({"_mask": mask, "_spans": spans})
    rest = rest.withColumns({"_tokens": F.split("_mask", DELIMITER, -1), "_delims": F.regexp_extract_all("_mask", F.lit(DELIMITER), F.lit(0))})

    # every run of pieces that may be one catalogue value: the numbers of pieces catalogue values have
    patterns = {f: c[3:] for f, c in fields.items() if c and c.startswith("re:")}
    listed_names = [
        catalogues[c].select(F.lit(f).alias("field_name"), trimmed(F.col(catalogues[c].columns[0])).alias("value")).distinct()
        for f, c in fields.items()
        if c and f not in patterns
    ]
    catalogue = reduce(DataFrame.unionByName, listed_names) if listed_names else None
    lengths = {1}
    if catalogue is not None:
        # quoted spans of a value may stand as one piece in a cell
        pieces = F.explode(F.array(*[F.size(F.split(c, DELIMITER, -1)) for c in (F.col("value"), masked(F.col("value"))[0])]))
        lengths |= {r.n for r in catalogue.where("value != ''").select(pieces.alias("n")).distinct().collect()}
    size = F.size("_tokens")
    runs = F.flatten(
        F.transform(
            F.array(*[F.lit(n) for n in sorted(lengths)]),
            lambda n: F.when(n <= size, F.transform(F.sequence(F.lit(0), size - n), lambda i: F.struct(i.alias("i"), (i + n - 1).alias("j")))).otherwise(F.array().cast("array<struct<i:int,j:int>>")),
        )
    )
    text = lambda i, j: F.array_join(
        F.transform(F.sequence(i, j), lambda t: F.concat(F.get("_tokens", t), F.when(t < j, F.get("_delims", t)).otherwise(""))), ""
    )
    run = rest.select("_key", "field_name", "_tokens", "_delims", "_spans", F.explode(runs).alias("_r"))
    run = run.select("_key", "field_name", F.col("_r.i").alias("i"), F.col("_r.j").alias("j"), trimmed(restored(text(F.col("_r.i"), F.col("_r.j")), F.col("_spans"))).alias("value"))
    found = [run.where((F.col("field_name") == f) & F.col("value").rlike(p)).select("_key", "field_name", "i", "j") for f, p in patterns.items()]
    if catalogue is not None:
        found.append(run.where(F.col("field_name").isin([f for f in fields if f not in patterns])).join(catalogue, ["field_name", "value"], "left_semi").select("_key", "field_name", "i", "j"))
    known = found[0] if found else run.where(F.lit(False)).select("_key", "field_name", "i", "j")
    for more in found[1:]:
        known = known.unionByName(more)
    known = known.groupBy("_key", "field_name").agg(F.collect_set(F.struct("i", "j")).alias("_known"))
    joined = rest.join(known, ["_key", "field_name"], "left")

    @F.pandas_udf("array<struct<i:int,j:int>>")
    def choose(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for tokens, delims, known_runs, expected in parts:
            yield pd.Series(
                [
                    [{"i": i, "j": j} for i, j in readings([x.strip() for x in t], [x.strip() or x[:1] for x in d], set() if k is None else {(r["i"], r["j"]) for r in k}, None if e is None or e != e else int(e))]
                    for t, d, k, e in zip(tokens, delims, known_runs, expected, strict=True)
                ]
            )

    chosen = joined.withColumn("_pieces", choose("_tokens", "_delims", "_known", "_count"))
    split = chosen.select(
        "_key", "field_name", F.transform("_pieces", lambda r: restored(text(r["i"], r["j"]), F.col("_spans"))).alias("_values")
    )
    values = lists.unionByName(split).select("_key", "field_name", F.filter(F.transform("_values", trimmed), lambda v: v != "").alias("_values"))
    return values.select(F.col("_key").alias(key), "field_name", F.posexplode("_values").alias("pos", "value")).select(
        key, "field_name", (F.col("pos") + 1).cast("bigint").alias("pos"), "value"
    )
