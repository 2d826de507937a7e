"""Texts of an Arrow batch as one array of code points, and polynomial hashes of its stretches."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Two odd bases; hashes are taken modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
BASE_2 = 0xC2B2AE3D27D4EB4F
#: Characters of the texts handled at a time within a task; one longer text makes a piece of its own.
CHARS = 2_000_000


def text_pieces(batch: pa.RecordBatch, column: str = "text", most: int = CHARS) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows with about ``most`` bytes of text; every text stays whole."""
    import pyarrow.compute as pc

    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    which = np.cumsum(lengths) // most
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(which)) + 1, [batch.num_rows]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts on end (uint32), and the offset of each text (one more than texts). Null is empty."""
    strings = [x or "" for x in texts.to_pylist()]
    offsets = np.zeros(len(strings) + 1, np.int64)
    np.cumsum([len(x) for x in strings], out=offsets[1:])
    return np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


@functools.lru_cache(maxsize=8)
def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Stretches:
    """Hashes of any stretches of a code point array in constant time each."""

    def __init__(self, codes: np.ndarray, base: int = BASE):
        room = 1 << max(16, int(len(codes)).bit_length())
        self.back = powers(inverse(base), room)
        value = mix(codes.astype(np.uint64) + np.uint64(base & 0xFFFF))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(value * powers(base, room)[: len(codes)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all stretches of ``size``, by start."""
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:n]) * self.back[:n])
