"""Suffix order of one shard of text by external induced sorting.

Suffixes are tuples in queues, one for each first byte, taken from in the order of their
keys; what is taken induces its predecessors into the queues that are still to come. A
queue keeps its blocks in memory up to a bound and in a file of the task's own beyond it,
as Spark's own spills are. First the substrings between leftmost S-type positions are
sorted by induction and named; the string of names, at most half as long, is sorted in
turn; its order then seeds the induction of all suffixes.

Only the first ``depth`` bytes count: the order of names stops where suffixes agree in so
many bytes, and neighbours tell by the hash of their first ``depth`` bytes whether their
common prefix is that long.
"""

from __future__ import annotations

import tempfile

import numpy as np

from .blocks import mix, noise

QUEUE_BYTES = 256 << 20  # of suffix tuples in memory; the rest waits on disk


class BucketQueue:
    """A priority queue of blocks of suffixes; the key is the bucket, equal keys keep their order."""

    def __init__(self, buckets: int, bound: int = QUEUE_BYTES):
        self.blocks: list[list] = [[] for _ in range(buckets)]
        self.bound, self.held, self.file = bound, 0, None

    def push(self, bucket: int, block: np.ndarray) -> None:
        if self.held + block.nbytes > self.bound:
            if self.file is None:
                self.file = tempfile.TemporaryFile()  # unlinked at once, gone with the task
            self.file.seek(0, 2)
            self.blocks[bucket].append((self.file.tell(), len(block)))
            self.file.write(block.tobytes())
        else:
            self.held += block.nbytes
            self.blocks[bucket].append(block)

    def pop(self, bucket: int) -> np.ndarray:
        """All blocks of a bucket in the order they came."""
        out = []
        for block in self.blocks[bucket]:
            if isinstance(block, tuple):
                self.file.seek(block[0])
                block = np.frombuffer(self.file.read(block[1] * 8), np.int64)
            else:
                self.held -= block.nbytes
            out.append(block)
        self.blocks[bucket] = []
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def push_by(self, keys: np.ndarray, suffixes: np.ndarray) -> None:
        if not len(suffixes):
            return
        order = np.argsort(keys, kind="stable")
        keys, suffixes = keys[order], suffixes[order]
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for k, part in zip(keys[np.concatenate([[0], cuts])].tolist(), np.split(suffixes, cuts)):
            self.push(k, part)


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is S-type: smaller than the one that begins a byte later."""
    n = len(t)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(t[1:].astype(np.int16) - t[:-1].astype(np.int16))
    step[-1] = 1
    # a run of equal bytes has the type of its last
    at = np.where(step != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return step[np.minimum(nearest, n - 1)] > 0


def _induce(t: np.ndarray, s_type: np.ndarray, seeds: list[np.ndarray], bound: int) -> np.ndarray:
    """Order of all suffixes from that of the leftmost S-type ones, given for each first byte."""
    width = len(seeds)
    queue, l_part = BucketQueue(width, bound), []
    for c in range(width):
        current, whole = queue.pop(c), []
        while True:
            if len(current):
                whole.append(current)
                before = current[current > 0] - 1
                before = before[~s_type[before]]
                key = t[before]
                queue.push_by(key[key > c], before[key > c])
                current = before[key == c]
                if len(current):
                    continue
            break
        before = seeds[c][seeds[c] > 0] - 1
        queue.push_by(t[before], before)
        l_part.append(np.concatenate(whole) if whole else np.zeros(0, np.int64))
    queue, out = BucketQueue(width, bound), [None] * width
    for c in range(width - 1, -1, -1):
        current, whole = queue.pop(c), []  # largest first
        while True:
            if len(current):
                whole.append(current)
                before = current[current > 0] - 1
                before = before[s_type[before]]
                key = t[before]
                queue.push_by(key[key < c], before[key < c])
                current = before[key == c]
                if len(current):
                    continue
            break
        down = l_part[c][::-1]
        before = down[down > 0] - 1
        before = before[s_type[before]]
        queue.push_by(t[before], before)
        s_part = np.concatenate(whole)[::-1] if whole else np.zeros(0, np.int64)
        out[c] = np.concatenate([l_part[c], s_part])
    return np.concatenate(out)


def _by_first(t: np.ndarray, suffixes: np.ndarray, width: int) -> list[np.ndarray]:
    order = np.argsort(t[suffixes], kind="stable")
    return np.split(suffixes[order], np.searchsorted(t[suffixes][order], np.arange(1, width)))


def _sort_names(names: np.ndarray, symbols: int) -> np.ndarray:
    """Ranks of the suffixes of a string of names by their first ``symbols`` names, equal ones alike."""
    rank, reach = names, 1
    while reach < symbols and len(rank) and rank.max() + 1 < len(rank):
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-reach] = rank[reach:] + 1 if reach < len(rank) else ahead[:0]
        rank = np.unique(rank * (len(rank) + 2) + ahead, return_inverse=True)[1]
        reach *= 2
    return rank


def suffix_order(text: np.ndarray, depth: int, bound: int = QUEUE_BYTES) -> np.ndarray:
    """Positions of ``text`` (bytes) in the order of the suffixes' first ``depth`` bytes.

    Suffixes that agree in so many bytes stand together, in no particular order.
    """
    t = np.concatenate([text.astype(np.int16) + 1, np.zeros(1, np.int16)])
    width = 257
    s_type = _types(t)
    leftmost = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if len(leftmost) < 2:
        seeds = _by_first(t, leftmost, width)
        order = _induce(t, s_type, seeds, bound)
        return order[order < len(text)]
    # names of the substrings between leftmost S-type positions, ends included
    rough = _induce(t, s_type, _by_first(t, leftmost, width), bound)
    is_seed = np.zeros(len(t), bool)
    is_seed[leftmost] = True
    rough = rough[is_seed[rough]]
    end = np.append(leftmost[1:] + 1, len(t))
    place = np.zeros(len(t), np.int64)
    place[leftmost] = np.arange(len(leftmost))
    which = place[rough]
    value = prefix_hashes(t.astype(np.uint8), (t == 256).nonzero()[0])
    shape = value(rough, end[which] - rough)
    new = np.ones(len(rough), bool)
    new[1:] = (shape[1:] != shape[:-1]) | ((end[which] - rough)[1:] != (end[which] - rough)[:-1])
    names = np.zeros(len(leftmost), np.int64)
    names[which] = np.cumsum(new) - 1
    # a name stands for two bytes at least
    rank = _sort_names(names, depth // 2 + 1)
    sorted_seeds = leftmost[np.argsort(rank, kind="stable")]
    order = _induce(t, s_type, _by_first(t, sorted_seeds, width), bound)
    return order[order < len(text)]


def prefix_hashes(data: np.ndarray, marked: np.ndarray | None = None):
    """A function from starts and lengths to the hashes of those substrings; ``marked`` bytes differ from their kind."""
    base = 0xD1342543DE82EF95
    n = len(data) + 1
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base))]), dtype=np.uint64)
        inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(pow(base, -1, 1 << 64)))]), dtype=np.uint64)
        values = noise(257, 53)
        weights = values[data]
        if marked is not None and len(marked):
            weights[marked] = values[256]
        sums = np.zeros(n, np.uint64)
        np.cumsum(weights * power[: n - 1], out=sums[1:])

    def of(start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((sums[start + length] - sums[start]) * inverse[start])

    return of
