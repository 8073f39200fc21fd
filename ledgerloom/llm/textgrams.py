"""Code points and rolling character-gram hashes of Arrow string columns, without a Python loop over rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts in a row, offsets): text i is points[offsets[i]:offsets[i + 1]]. Nulls count as empty."""
    column = pc.fill_null(column, "")
    joined = "".join(column.to_pylist())
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4"), np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def gram_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """The mixed hash of the n code points from each position on; positions near the end have none."""
    count = max(0, len(points) - n + 1)
    h = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        h *= _MULT
        h += points[i : i + count]
    return mix(h)
