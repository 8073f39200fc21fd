"""Long exact spans shared between documents, by sparse suffix trees parted by prefix.

A suffix starts at an anchor: a position whose GRAM-gram has the smallest hash of some window. Any span of LEAST
characters holds a whole window, so two texts that share it share an anchor in it. Suffixes are parted by their
prefix of GRAM characters; only prefixes that stand in several documents are kept. In each part the sorted suffixes
and their longest common prefixes are the suffix tree: an internal node of depth r and a common left context of
LEAST - r characters give a repeat. Prefixes have variable length: a part too large for memory is split twice, by a
prefix of LONGER characters, which holds all nodes at least that deep, and by the left context that shallower ones
need; what is still too large goes on to whole spans without being collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .textgrams import code_points, mix

GRAM = 64
LEAST = 200
WINDOW = LEAST - GRAM + 1
#: Suffixes of one prefix that are held in memory together, and length of the prefix that parts larger ones.
PART = 4000
LONGER = 132


def _slide(x: np.ndarray, w: int, best: np.ufunc) -> np.ndarray:
    """best over x[i:i + w] for each i with a whole window."""
    n = len(x)
    blocks = -(-n // w)
    fill = np.zeros(blocks * w - n, x.dtype) if best is np.maximum else np.full(blocks * w - n, np.iinfo(x.dtype).max, x.dtype)
    grid = np.concatenate([x, fill]).reshape(blocks, w)
    ahead = best.accumulate(grid, axis=1).ravel()
    back = best.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[: n - w + 1], ahead[w - 1 : n])


def anchors(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, gram hash) of the anchors of texts of LEAST characters or more, laid end to end."""
    h = mix(points.astype(np.uint64) + np.uint64(1))
    width = 1
    while width < GRAM:
        h = mix(h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:])
        width *= 2
    n, top = len(points), np.iinfo(np.uint64).max
    h = np.concatenate([h >> np.uint64(1), np.full(n - len(h), top)])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = offsets[1:][owner]
    at = np.arange(n)
    h[at + GRAM > end] = top
    low = _slide(h, WINDOW, np.minimum)
    low[at[: len(low)] + LEAST > end[: len(low)]] = 0
    high = _slide(np.concatenate([np.zeros(WINDOW - 1, np.uint64), low, np.zeros(WINDOW - 1, np.uint64)]), WINDOW, np.maximum)[:n]
    chosen = np.flatnonzero((high == h) & (h != top))
    return owner[chosen], chosen - offsets[:-1][owner[chosen]], h[chosen]


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 128):
            batch = whole.slice(at, 128)
            text, pos, h = anchors(*code_points(batch.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), batch.column("doc").take(pa.array(text)), pa.array(pos.astype(np.int32))], ["h", "doc", "pos"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = ([], [], [], [], [])
        for doc, text, at in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), batch.column("at").to_pylist(), strict=True):
            for a in at:
                pos = a["pos"]
                out[0].append(a["h"])
                out[1].append(doc)
                out[2].append(pos)
                out[3].append(text[max(0, pos - WINDOW + 1) : pos])
                out[4].append(text[pos : pos + LEAST])
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.string()), pa.array(out[4], pa.string())], ["h", "doc", "pos", "before", "after"])


def common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    if a == b:
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def repeats(rows: list[tuple[int, int, str, str]]) -> Iterator[tuple[str, int, int, int]]:
    """(span, doc, start, end) from suffixes (doc, pos, before, after) of one part.

    span is LEAST characters that all rows with this span share; start and end bound what the row shares with
    another row of the same node, as far as the contexts go.
    """
    rows = sorted(rows, key=lambda r: r[3])
    deep = [common(rows[i][3], rows[i + 1][3]) for i in range(len(rows) - 1)]
    # internal nodes of the suffix tree: depth and range of rows
    nodes, stack = [], []
    for i, d in enumerate([*deep, 0]):
        start = i
        while stack and stack[-1][0] > d:
            depth, start = stack.pop()
            nodes.append((depth, start, i + 1))
        if d and (not stack or stack[-1][0] < d):
            stack.append((d, start))
    for depth, lo, hi in nodes:
        need = max(0, LEAST - depth)
        if depth < GRAM or need > WINDOW - 1:
            continue
        groups: dict[str, list] = {}
        for r in rows[lo:hi]:
            if len(r[2]) >= need:
                groups.setdefault(r[2][len(r[2]) - need :], []).append(r)
        for left, members in groups.items():
            if len({m[0] for m in members}) < 2:
                continue
            back = sorted((m[2][::-1], m[0], m[1]) for m in members)
            near = [common(back[i][0], back[i + 1][0]) for i in range(len(back) - 1)]
            span = left + members[0][3][:depth]
            for i, (_, doc, pos) in enumerate(back):
                yield span, doc, pos - max(near[i - 1] if i else 0, near[i] if i < len(near) else 0), pos + depth


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of the parts in rows sorted by h."""

    def out(parts: list[list]) -> pa.RecordBatch:
        found = [x for rows in parts if len(rows) > 1 for x in repeats(rows)]
        cols = list(zip(*found, strict=True)) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["span", "doc", "lo", "hi"])

    part, key = [], None
    for batch in batches:
        parts = []
        for h, *row in zip(*(batch.column(c).to_pylist() for c in ("h", "doc", "pos", "before", "after")), strict=True):
            if h != key:
                parts.append(part)
                part, key = [], h
            part.append(row)
        yield out(parts)
    yield out([part])


def shared_spans(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, spans) of texts (doc, text) with distinct doc.

    classes: (doc, rep) for texts that come more than once; rep is the smallest doc, which stands for all. spans:
    (s1, s2, doc, lo, hi): documents with equal (s1, s2) share a span of at least LEAST characters, in this one
    within [lo, hi). Texts that are null, blank or shorter than LEAST have no row; a span that comes again within one
    document only is none.
    """
    long = texts.where((F.length("text") >= LEAST) & F.col("text").rlike(r"\S"))
    ids = long.select("doc", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2"))
    several = ids.join(ids.groupBy("h1", "h2").agg(F.min("doc").alias("rep"), F.max("doc").alias("last")).where("rep < last"), ["h1", "h2"]).select("doc", "rep").distinct()
    single = long.join(several.where("doc != rep").select("doc"), "doc", "left_anti").select("doc", "text")
    found = single.mapInArrow(_anchored, "h bigint, doc bigint, pos int").repartition("h")
    again = found.groupBy("h").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n")).where("first < last")
    kept = found.join(again.select("h", "n"), "h")
    at = kept.groupBy("doc").agg(F.collect_list(F.struct("pos", "h")).alias("at"))
    parts = single.join(at, "doc").mapInArrow(_contexts, "h bigint, doc bigint, pos int, before string, after string")
    large = again.where(F.col("n") > PART).select("h", F.lit(True).alias("large"))
    parts = materialise(parts.join(large, "h", "left"), "suffixes")
    # two suffixes of a large part that share a span agree in LONGER characters after the anchor, or in enough before it
    left = LEAST - LONGER + 1
    deep = F.when(F.length("after") >= LONGER, F.xxhash64("h", F.substring("after", 1, LONGER)))
    shallow = F.when(F.length("before") >= left, F.xxhash64("h", F.lit(1), F.expr(f"right(before, {left})")))
    finer = parts.where("large").select(F.explode(F.filter(F.array(deep, shallow), lambda x: x.isNotNull())).alias("h2"), "doc", "pos", "before", "after")
    sizes = finer.groupBy("h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n")).where("first < last")
    finer = materialise(finer.join(sizes.select("h2", "n"), "h2"), "finer")
    small = parts.where("large is null").drop("large").unionByName(finer.where(F.col("n") <= PART).drop("n").withColumnRenamed("h2", "h"))
    trees = small.repartition("h").sortWithinPartitions("h").mapInArrow(_trees, "span string, doc bigint, lo int, hi int")
    # what is still large goes on to whole spans, one for each start before the anchor
    starts = F.sequence(F.lit(0), F.length("before"))
    span = F.substr(F.concat("before", "after"), F.length("before") - F.col("t") + 1, F.lit(LEAST))
    whole = finer.where(F.col("n") > PART).select("doc", "pos", "before", "after").distinct()
    split = whole.withColumn("t", F.explode(starts)).withColumn("span", span).where(F.length("span") == LEAST)
    split = split.select("span", "doc", (F.col("pos") - F.col("t")).alias("lo"), (F.col("pos") - F.col("t") + LEAST).alias("hi"))
    named = [F.xxhash64("span").alias("s1"), F.xxhash64("span", F.lit(1)).alias("s2"), "doc", "lo", "hi"]
    split = split.select(*named)
    several_docs = split.groupBy("s1", "s2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("s1", "s2")
    spans = trees.select(*named).unionByName(split.join(several_docs, ["s1", "s2"], "left_semi"))
    return several, materialise(spans.distinct(), "spans")


def sharing_pairs(classes: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: all pairs of documents that share a span."""
    s = spans.select("s1", "s2", "doc").distinct()
    reps = s.join(s.withColumnRenamed("doc", "other"), ["s1", "s2"]).where("doc < other").select(F.col("doc").alias("a"), F.col("other").alias("b")).distinct()
    inside = classes.join(classes.withColumnRenamed("doc", "other"), "rep").where("doc < other").select(F.col("doc").alias("a"), F.col("other").alias("b"))
    for side in ("a", "b"):
        reps = reps.join(classes.select(F.col("rep").alias(side), F.col("doc").alias("m")), side, "left").withColumn(side, F.coalesce("m", side)).drop("m")
    return reps.unionByName(inside).select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).distinct()


def shared_parts(texts: DataFrame, classes: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, n_chars, shared_chars, share): how much of each text also stands in another document; null texts have size 0."""
    earlier = Window.partitionBy("doc").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", F.coalesce(F.max("hi").over(earlier), F.lit(0))))
    covered = spans.select("doc", "lo", "hi").distinct().withColumn("fresh", fresh).groupBy("doc").agg(F.sum("fresh").alias("covered"))
    out = texts.select("doc", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars")).join(covered, "doc", "left").join(classes, "doc", "left")
    chars = F.when(F.col("rep").isNotNull(), F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0))).cast("bigint")
    return out.select("doc", "n_chars", chars.alias("shared_chars"), F.when(F.col("n_chars") > 0, F.round(chars / F.col("n_chars"), 6)).otherwise(0.0).alias("share"))
