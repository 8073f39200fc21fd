"""The k most similar vectors of every vector, by a forest of sorted hash strings.

Each tree hashes a vector to a string of BITS signs of random projections and keeps the strings sorted. The
string's prefix, as long as needed for a bucket of bounded size, partitions a tree; within a partition a query
descends to the leaf of its longest matching prefix and ascends to sorted neighbours for more candidates.
Similarities of candidates are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialise

BITS = 60
TREES = 16
LEAF = 384
#: Candidates a query sees in a tree at least, if its partition has as many.
LEAST = 640
#: Rows of a partition of a tree on average, most before its prefix gets longer, and bits it gets longer by each time.
BUCKET = 4096
HEAVY = 32768
LONGER = 8


def usable(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """(id, vec): rows whose vector has dim finite numbers that are not all zero; one row per id."""
    v = F.col(vec_col).cast("array<double>")
    # a null element makes forall null and the row unusable
    fine = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists(v, lambda x: x != 0)
    return df.where(fine & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<float>").alias("vec")).dropDuplicates(["id"])


def _planes(dim: int, trees: int) -> np.ndarray:
    return np.random.default_rng(20240229).standard_normal((dim, trees * BITS))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if isinstance(column, pa.ChunkedArray) else column.flatten()
    m = flat.to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)  # squares of tiny or huge numbers stay finite
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def leaves(keys: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Ranges of sorted keys with a common prefix, each as long as a prefix allows but of at most size rows if keys differ."""
    done, todo = [], [(0, len(keys), BITS - 1)]
    while todo:
        lo, hi, bit = todo.pop()
        if hi - lo <= size or bit < 0:
            done.append((lo, hi))
            continue
        base = (int(keys[lo]) >> (bit + 1) << (bit + 1)) | (1 << bit)
        mid = lo + int(np.searchsorted(keys[lo:hi], base))
        todo += [part for part in ((lo, mid, bit - 1), (mid, hi, bit - 1)) if part[1] > part[0]]
    return sorted(done)


def _search(table: pa.Table, dim: int, k: int) -> pa.Table:
    """Best k of the candidates of each row within one partition of a tree."""
    ids, keys = table["id"].to_numpy(), table["key"].to_numpy()
    order = np.lexsort((ids, keys))
    ids, keys, unit = ids[order], keys[order], _matrix(table["vec"], dim)[order]
    out_id, out_n, out_s, out_len = [], [], [], []
    for lo, hi in leaves(keys, LEAF):
        pad = max(LEAF // 4, (LEAST - (hi - lo) + 1) // 2)
        a, b = max(0, lo - pad), min(len(ids), hi + pad)
        by_id = np.argsort(ids[a:b], kind="stable")
        near_ids, near = ids[a:b][by_id], unit[a:b][by_id]
        n = b - a
        take = min(k, n - 1)
        if take < 1:
            continue
        for s in range(lo, hi, 1024):  # a leaf of equal keys may be large
            e = min(hi, s + 1024)
            score = np.rint((unit[s:e] @ near.T) * 1e6).astype(np.int64)
            # of equal similarities the smaller id is the larger number
            rank = score * n + (n - 1 - np.arange(n))
            rank[np.arange(e - s), np.searchsorted(near_ids, ids[s:e])] = np.iinfo(np.int64).min
            best = np.argpartition(rank, n - take, axis=1)[:, n - take :]
            out_id.append(ids[s:e])
            out_n.append(near_ids[best].ravel())
            out_s.append(np.take_along_axis(score, best, axis=1).ravel())
            out_len.append(np.full(e - s, take))
    if not out_id:
        return pa.table({"id": pa.array([], pa.int64()), "near": pa.array([], NEAR)})
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(out_len))]).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(-np.concatenate(out_s)), pa.array(np.concatenate(out_n))], names=["d", "n"])
    return pa.table({"id": pa.array(np.concatenate(out_id)), "near": pa.ListArray.from_arrays(pa.array(offsets), pairs)})


NEAR = pa.list_(pa.struct([("d", pa.int64()), ("n", pa.int64())]))


def nearest(vectors: DataFrame, dim: int, k: int, trees: int = TREES, rows: int | None = None) -> DataFrame:
    """(id, near array<struct<d, n>>): for each row of (id, vec) its k most similar rows in order; d is minus the similarity in millionths.

    A prefix gets longer for as long as its bucket holds more than HEAVY rows. Vectors too many of which agree in all BITS
    signs of a tree are parted by a hash there, another one in each tree, so that no task holds them all.
    """
    rows = vectors.count() if rows is None else rows
    prefix = max(0, min(BITS - LONGER - 1, math.ceil(math.log2(max(rows, 1) / BUCKET)))) if rows > BUCKET else 0

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _planes(dim, trees)
        powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = (_matrix(batch.column("vec"), dim) @ planes > 0).reshape(-1, trees, BITS)
            keys = pa.array((signs * powers).sum(axis=2).ravel())
            offsets = pa.array(np.arange(0, batch.num_rows * trees + 1, trees, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.ListArray.from_arrays(offsets, keys)], ["id", "vec", "keys"])

    keyed = materialise(vectors.select("id", "vec").mapInArrow(hashed, "id bigint, vec array<float>, keys array<bigint>"), "keys")
    keys = keyed.select("id", F.posexplode("keys").alias("tree", "key"))
    at = lambda bits: F.shiftright("key", BITS - bits)
    # prefixes get longer for as long as a bucket is heavy; only its own rows are counted again
    open_, levels, bits = keys, [], prefix
    while True:
        heavy = materialise(open_.groupBy("tree", at(bits).alias("short")).agg(F.count("*").alias("n")).where(F.col("n") > HEAVY), "heavy")
        if heavy.isEmpty():
            break
        levels.append((bits, heavy))
        if bits == BITS:
            break
        open_ = open_.withColumn("short", at(bits)).join(heavy.select("tree", "short"), ["tree", "short"], "left_semi").drop("short")
        bits = min(bits + LONGER, BITS)
    strings = keyed.select("id", "vec", F.posexplode("keys").alias("tree", "key")).withColumns({"bits": F.lit(prefix), "split": F.lit(0)})
    for level, heavy in levels:
        # a bucket of whole strings is parted by another hash in each tree
        more = heavy.select("tree", F.col("short").alias("bucket"), F.lit(level).alias("bits"), F.ceil(F.col("n") / HEAVY).cast("int").alias("parts"))
        strings = strings.withColumn("bucket", F.when(F.col("bits") == level, at(level))).join(more, ["tree", "bucket", "bits"], "left")
        longer = F.col("parts").isNotNull()
        if level == BITS:
            strings = strings.withColumn("split", F.when(longer, F.pmod(F.xxhash64("id", "tree"), F.col("parts")).cast("int")).otherwise(F.col("split")))
        else:
            strings = strings.withColumn("bits", F.when(longer, min(level + LONGER, BITS)).otherwise(F.col("bits")))
        strings = strings.drop("bucket", "parts")
    bucket = F.lit(0).cast("bigint")
    for level in {prefix, *(min(level + LONGER, BITS) for level, _ in levels)}:
        bucket = F.when(F.col("bits") == level, at(level)).otherwise(bucket)
    grouped = strings.select("tree", "bits", "split", bucket.alias("bucket"), "id", "key", "vec").groupBy("tree", "bits", "split", "bucket")
    found = grouped.applyInArrow(lambda t: _search(t, dim, k), "id bigint, near array<struct<d:bigint,n:bigint>>")
    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k)
    return found.groupBy("id").agg(merged.alias("near"))


def neighbour_pairs(df: DataFrame, id_col: str, vec_col: str, dim: int, k: int, trees: int = TREES) -> DataFrame:
    """(vec_a, vec_b), vec_a < vec_b: one of the two is among the k most similar of the other.

    Similarity is the cosine in double precision, rounded to 6 decimals; ties go to the smaller id. Unusable
    vectors (null, wrong length, not finite, all zero) are left out; an id that comes twice counts once; fewer
    than two usable vectors give no pair. Equal vectors form a class that is searched once: only the k + 1
    smallest ids of a class can be in any list, so the others need no place in the forest.
    """
    rows = usable(df, id_col, vec_col, dim)
    classes = rows.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    near = nearest(classes.select("id", "vec"), dim, k, trees)
    several = classes.where("copies > 1")
    members = rows.join(several.select("vec", F.col("id").alias("rep")), "vec").select("id", "rep")
    first = Window.partitionBy("rep").orderBy("id")
    listed = members.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).groupBy("rep").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    # the ids of each listed class, then the list of each class over ids instead of classes
    flat = near.select("id", F.explode("near").alias("p")).select("id", "p.d", F.col("p.n").alias("rep"))
    own = listed.select(F.col("rep").alias("id"), F.lit(-1_000_000).cast("bigint").alias("d"), "ids")
    wide = flat.join(listed, "rep", "left").select("id", "d", F.coalesce("ids", F.array("rep")).alias("ids")).unionByName(own)
    lists = wide.groupBy("id").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("d").alias("d"), i.alias("n")))))), 1, k + 1).alias("near")
    )
    asking = lists.join(members.select(F.col("rep").alias("id"), F.col("id").alias("member")), "id", "left").select(F.coalesce("member", "id").alias("id"), "near")
    best = asking.select("id", F.explode(F.slice(F.filter("near", lambda p: p["n"] != F.col("id")), 1, k)).alias("p"))
    return best.select(F.least("id", "p.n").alias("vec_a"), F.greatest("id", "p.n").alias("vec_b")).distinct()
