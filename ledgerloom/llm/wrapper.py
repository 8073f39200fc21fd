"""Main text of web pages by wrapper induction over the pages of a host.

A page is a tree of blocks and lines. Pages of one host are aligned by simple tree matching; lines that match are
constant nodes of the host's template. Lines vary inside a template too (counters, addresses, lists of other
articles), so every line has several keys from exact to general; the exact key names a node of its host's template. A table
of nodes holds for each key in how many pages it occurs, at the edge of how many in a matched run, and in how many pages
without a frame. Keys that never occur in frameless pages belong to the site; sub-heads, which recur as well, do occur there.

All counts are exact. Pages stay in units of about GROUP pages of a host; a unit sends each of its keys once, and the nodes
that recur come back to the units that hold them, so neither a key nor a host is ever one task's or the driver's.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .scans import is_scan, is_wrapped

#: Keys of a line: exact within the host, exact, label before a colon, names masked, first and last signs.
KEYS = 6
#: Pages of a host that are aligned in one group, and partners of a page in it.
GROUP, PARTNERS = 100, 4
#: Pages a key is in at least to be a node of a template.
RECURS = 3
#: Chance that an article's key is missing from all frameless pages although it may stand there.
CHANCE = 1e-4
SENTENCE = re.compile(r"。|；|[a-z0-9)%]\.(?:\s|$)|[a-z]; ")
NAV = re.compile(r"\s*[|/·»>＞]\s*|　+|\s{2,}")
NUMBER = re.compile(r"\d[\d,.]*")
NAME = re.compile(r"\b[A-Z][A-Za-z'-]+(?: (?:[A-Z][A-Za-z'-]+|and|of|&))*")


def masked(line: str) -> str:
    return NUMBER.sub("9", line.strip()).lower()


def is_nav(line: str) -> bool:
    """Two or more short items between separator signs."""
    parts = [p for p in NAV.split(re.sub(r"^[^：:]{2,14}[：:]\s*", "", line.strip())) if p]
    return len(parts) >= 2 and all(len(p) <= 16 and not re.search(r"[。，；\d]", p) for p in parts) and line.strip()[0] not in "·>-•▪*"


def line_keys(line: str, host: str) -> list[int]:
    """Hashes of the keys of a line; 0 where a key doesn't apply."""
    import xxhash

    m, s = masked(line), line.strip()
    whole = bool(SENTENCE.search(s)) and len(s) > 60
    label = re.match(r"^[^：:。，,.]{2,24}[：:]", m)
    cjk = re.search(r"[一-鿿]", s)
    named = NUMBER.sub("9", NAME.sub("W", s)) if not cjk and not whole else ""
    words = m.split()
    first = "" if whole else m[:5] if cjk and len(m) > 7 else " ".join(words[:3]) if not cjk and len(words) > 4 else ""
    last = "" if whole else m[-6:] if cjk and len(m) > 8 else " ".join(words[-3:]) if not cjk and len(words) > 4 else ""
    bullet = re.match(r"^([·>▪»※◆◇■□▸►•*–-])\s", s)
    if bullet:
        first, last = "bullet" + bullet.group(1), ""
    keys = [host + "\n" + m, "=" + m, "l" + label.group(0) if label and label.end() < len(m) else "", "n" + named if len(named) > 3 and named.strip("W9 ") else "", "f" + first if first else "", "e" + last if last else ""]
    return [xxhash.xxh64_intdigest(k.encode("utf-8", "replace")) >> 1 if k else 0 for k in keys]


def matching(a: list[list[int]], b: list[list[int]]) -> set[tuple[int, int]]:
    """Simple tree matching of two pages: the pairs (block, line) of a that match, for the largest number of matches.

    Blocks and lines keep their order; lines match if their labels are equal, blocks as well as their lines do.
    """

    def best(n: int, m: int, gain) -> list[tuple[int, int, list]]:
        table = [[0] * (m + 1) for _ in range(n + 1)]
        kept = {}
        for i in range(1, n + 1):
            for j in range(1, m + 1):
                w = gain(i - 1, j - 1)
                kept[i, j] = w
                table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + w[0])
        out, i, j = [], n, m
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                out.append((i - 1, j - 1, kept[i, j][1]))
                i, j = i - 1, j - 1
        return out

    def lines(x: list[int], y: list[int]) -> tuple[int, list[int]]:
        shared = set(x) & set(y)
        if not shared:
            return 0, []
        p, q = [i for i, v in enumerate(x) if v in shared], [j for j, v in enumerate(y) if v in shared]
        got = best(len(p), len(q), lambda i, j: (1, None) if x[p[i]] == y[q[j]] else (0, None))
        return len(got), [p[i] for i, _, _ in got]

    return {(i, k) for i, _, inside in best(len(a), len(b), lambda i, j: lines(a[i], b[j])) for k in inside}


def _aligned(key: tuple, table: pa.Table) -> pa.Table:
    """Pages of one group of a host, which are a unit, with the keys, flags and alignment of their lines."""
    import xxhash

    table = table.sort_by("id")
    ids, texts, host = table["id"].to_pylist(), table["text"].to_pylist(), table["host"][0].as_py() or ""
    pages = []
    for t in texts:
        lines = t.split("\n")
        keys = [line_keys(x, host) if x.strip() else [0] * KEYS for x in lines]
        blocks: list[list[int]] = [[]]
        for i, x in enumerate(lines):
            if x.strip():
                blocks[-1].append(i)
            elif blocks[-1]:
                blocks.append([])
        pages.append((lines, keys, [b for b in blocks if b]))
    out_keys, out_flags = [], []
    n = len(pages)
    for p, (lines, keys, blocks) in enumerate(pages):
        matched = np.zeros(len(lines), dtype=bool)
        partners = [q for q in dict.fromkeys((p + d) % n for d in range(1, PARTNERS + 1)) if q != p and texts[q] != texts[p]]
        label = lambda page: [[page[1][i][1] for i in b] for b in page[2]]
        mine = label(pages[p])
        for q in partners:
            got = [blocks[b][k] for b, k in matching(mine, label(pages[q]))]
            # a reprint of the same article says nothing about the template
            if sum(bool(SENTENCE.search(lines[i])) for i in got) <= 0.3 * max(4, sum(bool(SENTENCE.search(x)) for x in lines)):
                matched[got] = True
        full = [i for i, x in enumerate(lines) if x.strip()]
        edge = np.zeros(len(lines), dtype=bool)
        for order in (full, full[::-1]):
            for i in order:
                if not matched[i] and not is_nav(lines[i]):
                    break
                edge[i] = True
        sentence = np.array([bool(SENTENCE.search(x)) for x in lines])
        broken = is_wrapped([x for x in lines if len(x.strip()) > 12])
        blank = np.array([not x.strip() for x in lines])
        nav = np.array([bool(x.strip()) and is_nav(x) for x in lines])
        flags = matched * 1 + edge * 2 + sentence * 4 + blank * 8 + nav * 16 + (len(partners) > 0) * 32 + broken * 64
        out_keys.append(np.array(keys, dtype=np.int64).ravel())
        out_flags.append(flags.astype(np.int8))
    unit = xxhash.xxh64_intdigest(f"{key[1].as_py()}\n{host}".encode("utf-8", "replace")) >> 1
    return pa.table(
        {
            "unit": pa.array([unit] * n, pa.int64()), "id": table["id"], "keys": pa.array(out_keys, pa.list_(pa.int64())), "flags": pa.array([f.tobytes() for f in out_flags], pa.binary()),
        }
    )


UNIT = "unit bigint, id bigint, keys array<bigint>, flags binary"


def _pages(rows: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, list[tuple[int, np.ndarray, np.ndarray]]]]:
    """(unit, pages) with (id, keys by line, flags by line) of each page, for pages whose units lie side by side."""
    unit, pages = None, []
    for row, (u, i) in enumerate(zip(rows["unit"].to_pylist(), rows["id"].to_pylist(), strict=True)):
        if u != unit and pages:
            yield unit, pages
            pages = []
        unit = u
        pages.append((i, rows["keys"][row].values.to_numpy().reshape(-1, KEYS), np.frombuffer(rows["flags"][row].as_buffer(), dtype=np.int8)))
    if pages:
        yield unit, pages


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each unit, once in a batch: pages that hold it, pages at whose edge it stands, whether it is navigation."""
    for b in batches:
        for unit, pages in _pages(b):
            k = np.concatenate([x.ravel() for _, x, _ in pages])
            f = np.repeat(np.concatenate([x for _, _, x in pages]), KEYS)
            page = np.repeat(np.arange(len(pages)), [x.size for _, x, _ in pages])
            order = np.lexsort((page, k))
            order = order[np.searchsorted(k[order], 1) :]  # 0 where a key doesn't apply
            if not len(order):
                continue
            k, f, page = k[order], f[order], page[order]
            once = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (page[1:] != page[:-1])]))
            edge = np.maximum.reduceat((f & 2 > 0).astype(np.int64), once)
            nav = np.maximum.reduceat((f & 16 > 0).astype(np.int64), once)
            own = k[once]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            n = np.diff(np.concatenate([first, [len(own)]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), unit)), pa.array(own[first]), pa.array(n), pa.array(np.add.reduceat(edge, first)), pa.array(np.maximum.reduceat(nav, first))], ["unit", "key", "n", "edge", "nav"])


class Nodes:
    """Counts of the nodes that a unit's keys are; 0 for keys that are none."""

    def __init__(self, table: pa.Table) -> None:
        self.table = table.sort_by("key")
        self.keys = self.table["key"].to_numpy()

    def of(self, keys: np.ndarray, column: str) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(keys.shape, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.table[column].to_numpy()[at], 0)


def _real(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys[keys != 0])


def _follows(f: np.ndarray) -> np.ndarray:
    """Lines after the last sentence that are followed by a line that neither matches nor is a sentence or navigation."""
    last = np.flatnonzero((f & 4 > 0) & (f & 1 == 0))
    at = np.arange(len(f)) > (last[-1] if len(last) else len(f))
    after = np.zeros(len(f), dtype=bool)
    after[:-1] = f[1:] & (1 | 4 | 8 | 16) == 0
    return at & after


def site_lines(pages: DataFrame) -> DataFrame:
    """(id, line_no) of the non-empty lines of web pages (id, host, text) that belong to the site and not to the main text.

    Null and blank texts and scans have none; a null host counts as one host; rows that come twice under one id count
    once. A page alone in its host is judged by the general keys only. Hosts with many pages are aligned in groups of
    about GROUP, whose counts are summed, so no host is one task.
    """
    def no_scans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([not is_scan(t.as_py().split("\n")) for t in b.column("text")], pa.bool_()))

    rows = pages.where(F.col("text").rlike(r"\S")).select("id", F.coalesce("host", F.lit("")).alias("host"), "text").dropDuplicates(["id"])
    rows = rows.mapInArrow(no_scans, "id bigint, host string, text string")
    sizes = pages.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    grouped = rows.join(sizes, "host").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).select("id", "host", "text", "part")
    trees = materialise(grouped.groupBy("host", "part").applyInArrow(_aligned, UNIT), "trees")
    # the nodes each unit holds: keys that recur over all units, and navigation
    whole = Window.partitionBy("key")
    uses = trees.mapInArrow(_uses, "unit bigint, key bigint, n bigint, edge bigint, nav bigint")
    counted = uses.select("unit", "key", F.sum("n").over(whole).alias("n"), F.sum("edge").over(whole).alias("edge"), F.max("nav").over(whole).alias("nav"))
    held = materialise(counted.where((F.col("n") >= RECURS) | (F.col("nav") == 1)).drop("nav"), "nodes")

    def frameless(units: pa.Table, own: pa.Table) -> pa.Table:
        nodes, bare, head, totals = Nodes(own), [np.empty(0, np.int64)], [np.empty(0, np.int64)], [0, 0]
        for _, unit in _pages(units):
            for _, k, f in unit:
                recur = lambda x: x[nodes.of(x, "n") >= RECURS]
                head.append(recur(_real(k[_follows(f), :3])))
                plain = _real(k[f & 4 == 0, 1])
                n = nodes.of(plain, "n")
                framed = (f & 18 > 0).any() or ((n >= 12) & (nodes.of(plain, "edge") >= 0.5 * n)).any()
                totals[0] += 1
                if not framed and len(f) and f[0] & 32:
                    bare.append(recur(_real(k)))
                    totals[1] += 1
        (a, n_bare), (b, n_head) = (np.unique(np.concatenate(x), return_counts=True) for x in (bare, head))
        zeros = lambda x: np.zeros(len(x), np.int64)
        cols = [np.concatenate(x) for x in ((a, b), (n_bare, zeros(b)), (zeros(a), n_head))]
        names = ["key", "bare", "head"]
        sums = pa.table({**{c: pa.array(x) for c, x in zip(names, cols, strict=True)}, "pages": pa.nulls(len(cols[0]), pa.int64()), "frameless": pa.nulls(len(cols[0]), pa.int64())})
        total = pa.table({**{c: pa.nulls(1, pa.int64()) for c in names}, "pages": pa.array([totals[0]]), "frameless": pa.array([totals[1]])})
        return pa.concat_tables([sums, total])

    units = trees.groupBy("unit")
    seen = materialise(units.cogroup(held.groupBy("unit")).applyInArrow(frameless, "key bigint, bare bigint, head bigint, pages bigint, frameless bigint"), "frameless")
    totals = seen.agg(F.sum("pages").alias("pages"), F.sum("frameless").alias("frameless")).first()
    share = min(0.9, max(0.02, (totals["frameless"] or 0) / max(1, totals["pages"] or 0)))
    least = max(6, math.ceil(math.log(CHANCE) / math.log(1 - share)))
    sums = seen.where("key is not null").groupBy("key").agg(F.sum("bare").alias("bare"), F.sum("head").alias("head"))
    known = held.join(sums, "key", "left").na.fill(0, ["bare", "head"])

    def judge(units: pa.Table, own: pa.Table) -> pa.Table:
        nodes, out_id, out_no = Nodes(own), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, k, f in (page for _, unit in _pages(units) for page in unit):
            n, clean, rim, heads = nodes.of(k, "n"), nodes.of(k, "bare"), nodes.of(k, "edge"), nodes.of(k[:, :2], "head")
            absent = (clean <= 0.01 * n) & (k != 0)
            rims = rim >= 0.2 * n
            sentence = f & 4 > 0
            # an article's list item may recur by chance, but not at the edge of pages or very often
            common = absent[:, 1] & (n[:, 1] >= 2 * least)
            site = common | absent[:, 1] & rims[:, 1] & (n[:, 1] >= least)
            site |= absent[:, 0] & absent[:, 1] & rims[:, 0] & (n[:, 0] >= 3)
            site |= absent[:, 0] & absent[:, 1] & ((f & 1 > 0) & (n[:, 0] >= max(6, least // 3)) | (n[:, 0] >= least))
            site |= absent[:, 2] & (n[:, 2] >= least) & ~sentence
            # where an article's lines are broken, their starts and ends recur as well
            free = rims[:, 3:] | (f[:1] & 64 == 0)
            site |= (absent[:, 3:] & free & (n[:, 3:] >= 2 * least)).any(axis=1) & ~(sentence & (f & 1 == 0))
            site |= (f & 16 > 0) & absent[:, 1]
            site &= f & 8 == 0
            # lists of other articles below a head of such lists
            body = np.flatnonzero(sentence & ~site)
            bottom = body[-1] if len(body) else -1
            inside = False
            for x in range(len(f)):
                if f[x] & 8:
                    inside = False
                elif site[x]:
                    inside = bool(x > bottom and (heads[x, :2] >= 0.5 * np.maximum(1, n[x, :2])).any())
                elif inside and not sentence[x]:
                    site[x] = True
            where = np.flatnonzero(site)
            out_id.append(np.full(len(where), i))
            out_no.append(where + 1)
        return pa.table({"id": pa.array(np.concatenate(out_id)), "line_no": pa.array(np.concatenate(out_no))})

    return units.cogroup(known.groupBy("unit")).applyInArrow(judge, "id bigint, line_no bigint")


def main_text(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(id, text): pages (id, text) without their site lines, in order."""
    drop = found.groupBy("id").agg(F.collect_set("line_no").alias("drop"))
    lines = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(F.coalesce("drop", F.array().cast("array<bigint>")), (i + 1).cast("bigint")))
    return pages.dropDuplicates(["id"]).join(drop, "id", "left").select("id", F.array_join(lines, "\n").alias("text"))
