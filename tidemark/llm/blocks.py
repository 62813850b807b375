"""Arrow text columns as byte blocks, and vectorised hashing of what is in them.

A worker handles a batch in blocks of about ``BLOCK_BYTES``, so the memory it needs does
not depend on how many rows Spark puts into a batch. A single longer text is one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
POWERS_KEPT = 4096  # positions in a word that weigh differently; longer words start over

_GOLDEN = 0x9E3779B97F4A7C15
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def noise(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit integers."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)
        return mix(steps * np.uint64(_GOLDEN)) | np.uint64(1)


def byte_values(letters: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """A 64-bit value for each byte: 0 for bytes outside words, capitals as small letters."""
    values = noise(256, 11)
    if fold_case:
        values[65:91] = values[97:123]
    values[~letters] = 0
    return values


def word_powers() -> np.ndarray:
    return noise(POWERS_KEPT, 29)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows and of the end) of each block; null is empty."""
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """Where words begin and end in a block, and their hashes.

    ``start``/``end``: byte positions; ``text_first[i]``: the first word of text i, with one
    more entry for the end. A word never crosses the end of a text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, values: np.ndarray, powers: np.ndarray):
        v = values[data]
        inside = v != 0
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[firsts] |= inside[firsts]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:]
        lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        stop[lasts] |= inside[lasts]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.text_first = np.searchsorted(self.start, offsets)
        at = np.arange(len(data))
        origin = np.zeros(len(data), np.int64)
        origin[self.start] = self.start
        np.maximum.accumulate(origin, out=origin)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(v * powers[(at - origin) & (POWERS_KEPT - 1)], out=self.sums[1:])

    def hashes(self, length: int | None = None) -> np.ndarray:
        """The hash of every word, or of its first ``length`` bytes."""
        end = self.end if length is None else np.minimum(self.end, self.start + length)
        return mix(self.sums[end] - self.sums[self.start])
