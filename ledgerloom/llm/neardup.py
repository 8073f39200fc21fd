"""Near-duplicate texts by MinHash banding and Bayesian pruning of candidate pairs.

Equal texts form a class that is handled once. Bands of MinHash values propose pairs of classes; the values of a
pair are compared in steps, and a pair is dropped as soon as the posterior probability that its similarity
reaches the threshold is below a tolerance. The rest is verified exactly on its character grams.

Groups need no list of all pairs: the members of each band group are linked to its first member, what is verified
forms components, and only pairs between different components are proposed after that.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graphs import components
from ..sources.tables import materialise
from .textgrams import code_points, gram_hashes, mix

GRAM = 5
BANDS = 34
ROWS = 5
#: Bits kept of each MinHash value for the comparison, and values in a 64-bit word.
KEPT = 4
IN_WORD = 64 // KEPT
#: Words of a signature that are compared.
WORDS = 8
TOLERANCE = 5e-4
#: Classes of a band value that are paired at once; larger groups are cut into blocks of about BLOCK times as many, and each two blocks are paired.
GROUP, BLOCK = 512, 4


@lru_cache
def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For 1..WORDS compared words the fewest matching values with which a pair stays.

    Prior: similarity uniform on [0, 1]. A value of a pair with similarity s matches with probability s + (1 - s) / 2^KEPT.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 2**KEPT
    out = []
    for w in range(1, WORDS + 1):
        n = w * IN_WORD
        for m in range(n + 1):
            like = m * np.log(p) + (n - m) * np.log1p(-p)
            like = np.exp(like - like.max())
            if like[s >= threshold].sum() / like.sum() >= tolerance:
                out.append(m)
                break
    return out


def minhashes(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values (texts x BANDS * ROWS) of the distinct GRAM-grams of texts with at least one gram."""
    factors = np.random.default_rng(977).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    h = gram_hashes(points, GRAM)
    keep = np.ones(len(h), dtype=bool)
    for back in range(1, GRAM):  # grams that reach over the end of a text
        cut = offsets[1:-1] - back
        keep[cut[cut < len(h)]] = False
    lengths = np.diff(offsets) - GRAM + 1
    h = h[keep]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    out = np.empty((len(lengths), len(factors)), dtype=np.uint64)
    for i, a in enumerate(factors):
        out[:, i] = np.minimum.reduceat(h * a, starts)
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shifts = np.arange(IN_WORD, dtype=np.uint64) * np.uint64(KEPT)
    salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for whole in batches:
        for at in range(0, whole.num_rows, 64):  # small slices keep the hashes in cache
            batch = whole.slice(at, 64)
            values = minhashes(*code_points(batch.column("text")))
            banded = values.reshape(-1, BANDS, ROWS)
            key = np.broadcast_to(salt, banded.shape[:2]).copy()
            key += mix(batch.column("uid").to_numpy().astype(np.uint64) & np.uint64(1))[:, None]
            for r in range(ROWS):
                key = mix(key ^ banded[:, :, r])
            bits = (values[:, : WORDS * IN_WORD] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - KEPT)).reshape(-1, WORDS, IN_WORD)
            words = np.bitwise_or.reduce(bits << shifts, axis=2)

            def lists(m: np.ndarray) -> pa.Array:
                offsets = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)
                return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.view(np.int64).ravel()))

            yield pa.RecordBatch.from_arrays([batch.column("uid"), lists(key), lists(words)], ["uid", "keys", "words"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first class of each key with each other one that has it, from rows sorted by key and uid."""
    key, first = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        k, u = batch.column("key").to_numpy(), batch.column("uid").to_numpy()
        start = np.concatenate([[True], k[1:] != k[:-1]])
        at = np.maximum.accumulate(np.where(start, np.arange(len(k)), 0))
        rep = np.where((k == key) & (first is not None), first if first is not None else 0, u[at])
        other = rep != u
        key, first = k[-1], rep[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(rep, u)[other]), pa.array(np.maximum(rep, u)[other])], ["a", "b"])


def _pairs(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.RecordBatch]:
    """Pairs of the classes that share a key and differ in part (or in uid, if there is none), from rows sorted by key; rows of groups of more than group come out as (uid, null, key)."""

    def out(a: np.ndarray, b: np.ndarray | None, key: np.ndarray | None) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a), none if b is None else pa.array(b), none if key is None else pa.array(key)], ["a", "b", "hot"])

    def crossing(at: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        x, y = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
        differ = c[x] != c[y]
        a, b = u[x[differ]], u[y[differ]]
        return out(np.minimum(a, b), np.maximum(a, b), None)

    empty = np.empty(0, np.int64)
    left_k, left_u, left_c, hot = empty, empty, empty, None
    for batch in batches:
        part = "part" if "part" in batch.schema.names else "uid"
        k, u, c = (np.concatenate([x, batch.column(n).to_numpy()]) for x, n in ((left_k, "key"), (left_u, "uid"), (left_c, part)))
        if not len(k):
            continue
        once = np.concatenate([[True], (k[1:] != k[:-1]) | (u[1:] != u[:-1])])  # a record may be delivered twice
        k, u, c = k[once], u[once], c[once]
        start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        size = np.diff(np.concatenate([start, [len(k)]]))
        last = start[-1]
        # the group at the end may go on in the next batch, unless it is known to be large already
        open_hot = size[-1] > group or k[last] == hot
        done = np.arange(len(size)) < len(size) - (not open_hot)
        large = done & ((size > group) | (k[start] == hot))
        if large.any():
            rows = np.concatenate([np.arange(s, s + n) for s, n in zip(start[large], size[large], strict=True)])
            yield out(u[rows], None, k[rows])
        small = done & ~large & (size > 1)
        for width in np.unique(size[small]):
            # bounds what is held at once
            at, (i, j) = start[small & (size == width)], np.triu_indices(width, 1)
            step = max(1, 1_000_000 // len(i))
            for s in range(0, len(at), step):
                yield crossing(at[s : s + step], i, j)
        hot = k[last] if open_hot else hot if k[last] == hot else None
        left_k, left_u, left_c = (empty,) * 3 if open_hot else (k[last:], u[last:], c[last:])
    if len(left_k) > 1:
        k, u, c = left_k, left_u, left_c
        yield crossing(np.zeros(1, np.int64), *np.triu_indices(len(u), 1))


def _block_pairs(t: pa.Table, least: list[int]) -> pa.Table:
    """Pairs of one block of a large group, or of two blocks of it, that differ in part and stay by their words.

    A pair may share several large groups; it comes out only for the first band that it shares.
    """
    uid, at = np.unique(t["a"].to_numpy(), return_index=True)  # a record may be delivered twice
    matrix = lambda c, n: t[c].combine_chunks().flatten().to_numpy().reshape(-1, n)[at]
    words, keys = matrix("words", WORDS).view(np.uint64), matrix("keys", BANDS)
    part, own, i, j, hot = t["part"].to_numpy()[at], t["own"].to_numpy()[at], t["i"][0].as_py(), t["j"][0].as_py(), t["hot"][0].as_py()
    x, y = np.flatnonzero(own == i), np.flatnonzero(own == j)
    ones = np.uint64(int("1" * IN_WORD, 2**KEPT))

    def same(v: np.ndarray) -> np.ndarray:
        v = v | v >> np.uint64(1)
        return IN_WORD - np.bitwise_count((v | v >> np.uint64(2)) & ones).astype(np.int16)

    got_a, got_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s in range(0, len(x), 256):  # bounds what is held at once
        rows = x[s : s + 256]
        seen = same(words[rows, 0][:, None] ^ words[y, 0][None, :])
        keep = (seen >= least[0]) & (part[rows][:, None] != part[y][None, :])
        if i == j:
            keep &= rows[:, None] < y[None, :]
        r, c = np.nonzero(keep)
        a, b, seen = rows[r], y[c], seen[r, c]
        for w in range(1, WORDS):
            seen = seen + same(words[a, w] ^ words[b, w])
            stays = seen >= least[w]
            a, b, seen = a[stays], b[stays], seen[stays]
        if len(a):
            first = np.argmax(keys[a] == keys[b], axis=1)
            here = keys[a, first] == hot
            got_a.append(uid[a[here]])
            got_b.append(uid[b[here]])
    a, b = np.concatenate(got_a), np.concatenate(got_b)
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    kept: dict[int, set[str]] = {}

    def grams(uid: int, text: str) -> set[str]:
        if uid not in kept:
            if len(kept) > 256:
                kept.clear()
            kept[uid] = {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}
        return kept[uid]

    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        both = []
        for x, y, s, t in zip(a, b, batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
            g, h = grams(x, s), grams(y, t)
            common = len(g & h)
            both.append(common / (len(g) + len(h) - common))
        j = np.array(both)
        fits = pa.array(j >= threshold - 1e-12)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(fits), batch.column("b").filter(fits), pa.array(j).filter(fits)], ["a", "b", "similarity"])


def _classes(texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(several, once, plain): the members of classes of equal texts, the signatures of one text of each class, and the texts."""
    texts = texts.where("text is not null")
    part = F.col("uid").bitwiseAND(1)
    ids = texts.select("uid", part.alias("part"), F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2"))
    classes = ids.groupBy("part", "h1", "h2").agg(F.min("uid").alias("rep"), F.max("uid").alias("last"))
    several = ids.join(classes.where("rep < last"), ["part", "h1", "h2"]).select("uid", "rep").distinct()
    copies = several.where("uid != rep").select("uid")
    # each class once; Spark broadcasts the copies only if they turn out few
    single = texts.where(F.length("text") >= GRAM).select("uid", "text").join(copies, "uid", "left_anti")
    return several, materialise(single.mapInArrow(_signatures, "uid bigint, keys array<bigint>, words array<bigint>"), "signatures"), texts.select("uid", "text")


def _compared(pairs: DataFrame, once: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that the comparison of their MinHash values leaves."""
    words = once.select("uid", "words")
    both = pairs.join(words.select(F.col("uid").alias("a"), F.col("words").alias("wa")), "a").join(words.select(F.col("uid").alias("b"), F.col("words").alias("wb")), "b")
    return both.where(_stays(threshold)).select("a", "b")


def _exact(pairs: DataFrame, plain: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs whose similarity is at least threshold."""
    full = pairs.join(plain.select(F.col("uid").alias("a"), F.col("text").alias("text_a")), "a").join(plain.select(F.col("uid").alias("b"), F.col("text").alias("text_b")), "b")
    return full.select("a", "b", "text_a", "text_b").mapInArrow(lambda x: _verified(x, threshold), "a bigint, b bigint, similarity double").distinct()


def _survivors(signed: DataFrame, threshold: float) -> DataFrame:
    """Pairs of rows of signed (uid, part, keys, words) that share a band, differ in part and are left by the comparison.

    Without part each row is its own.
    """
    rows = signed.select(*[c for c in signed.columns if c in ("uid", "part")], F.explode("keys").alias("key"))
    signed = signed if "part" in signed.columns else signed.withColumn("part", F.col("uid"))
    group, least = GROUP, least_matches(threshold, TOLERANCE)
    proposed = rows.repartition("key").sortWithinPartitions("key", "uid").mapInArrow(lambda x: _pairs(x, group), "a bigint, b bigint, hot bigint")
    proposed = materialise(proposed, "proposed")
    # a group that is too large to be paired at once: each of its rows goes to all pairs of blocks that its own block is in
    hot = proposed.where("hot is not null").select("a", "hot").distinct().join(signed.select(F.col("uid").alias("a"), "part", "keys", "words"), "a")
    blocks = hot.groupBy("hot").agg(F.ceil(F.count("*") / (group * BLOCK)).cast("int").alias("n"), F.min("part").alias("p1"), F.max("part").alias("p2")).where("p1 < p2")
    placed = hot.join(blocks.select("hot", "n"), "hot").withColumn("own", F.pmod(F.xxhash64("a"), F.col("n")).cast("int"))
    kept = ["hot", "a", "part", "own", "keys", "words"]
    placed = placed.select(*kept, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    placed = placed.select(*kept, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    in_blocks = placed.groupBy("hot", "i", "j").applyInArrow(lambda t: _block_pairs(t, least), "a bigint, b bigint")
    pairs = proposed.where("hot is null").select("a", "b").distinct()
    return _compared(pairs, signed, threshold).unionByName(in_blocks).distinct()


def similar_classes(texts: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(classes, links) of texts (uid, text); the lowest bit of uid parts collections that are not compared.

    classes: (uid, rep) with the smallest uid of the equal texts, one row per text. links: (a, b, similarity), a < b, for pairs of
    classes whose Jaccard similarity on distinct GRAM-grams is at least threshold. A text with no gram is linked with
    no other. Null texts have no row; a uid that comes twice with one text counts once. A pair at the threshold is proposed with probability
    1 - (1 - threshold^ROWS)^BANDS (0.998 at 0.7, 0.9999 at 0.75) and survives the pruning with about 1 - TOLERANCE per step.
    """
    several, once, plain = _classes(texts)
    return several, _exact(_survivors(once, threshold), plain, threshold)


def similar_groups(texts: DataFrame, threshold: float) -> DataFrame:
    """(uid, group) of the texts (uid, text) that are equal or similar to another one; group is the smallest uid connected with them.

    The same links as those of similar_classes hold the groups together, but no group lists its pairs: a band group gives
    one star, and pairs within a component that is known already are left out.
    """
    several, once, plain = _classes(texts)
    rows = once.select("uid", F.explode("keys").alias("key"))
    stars = rows.repartition("key").sortWithinPartitions("key", "uid").mapInArrow(_stars, "a bigint, b bigint").distinct()
    near = materialise(_exact(_compared(stars, once, threshold), plain, threshold).select("a", "b"), "stars")
    parts = components(near).select(F.col("node").alias("uid"), F.col("component").alias("part"))
    signed = materialise(once.join(parts, "uid", "left").withColumn("part", F.coalesce("part", "uid")), "parts")
    far = materialise(_exact(_survivors(signed, threshold), plain, threshold).select("a", "b"), "crossing")
    groups = components(near.unionByName(far)).select(F.col("node").alias("rep"), F.col("component").alias("group"))
    members = several.unionByName(groups.select(F.col("rep").alias("uid"), "rep").join(several, "uid", "left_anti"))
    return members.join(groups, "rep", "left").select("uid", F.coalesce("group", "rep").alias("group"))


def _stays(threshold: float) -> Column:
    """Compares one word of MinHash values after the other; false as soon as the matches so far are too few."""
    ones = int("1" * IN_WORD, 2**KEPT) if 2**KEPT <= 36 else 0
    seen, stays = F.lit(0), F.lit(True)
    for w, least in enumerate(least_matches(threshold, TOLERANCE)):
        x = F.get("wa", F.lit(w)).bitwiseXOR(F.get("wb", F.lit(w)))
        for step in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        seen = seen + (IN_WORD - F.bit_count(x.bitwiseAND(F.lit(ones))))
        stays = stays & (seen >= least)
    return stays


def expanded(classes: DataFrame, links: DataFrame) -> DataFrame:
    """All pairs (a, b), a < b, of different records: within classes of equal texts, and between linked classes."""
    c = classes
    inside = c.join(c.select(F.col("uid").alias("other"), "rep"), "rep").where("uid < other").select(F.col("uid").alias("a"), F.col("other").alias("b"))
    for side in ("a", "b"):
        links = links.join(c.select(F.col("rep").alias(side), F.col("uid").alias("_m")), side, "left").withColumn(side, F.coalesce("_m", side)).drop("_m")
    return inside.unionByName(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
