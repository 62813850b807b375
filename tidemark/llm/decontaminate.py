"""Benchmark decontamination by the q-gram lemma.

Texts and items are compared as UTF-8 bytes with ASCII capitals folded and runs of white
space as one space. Every item is cut into overlapping windows of ``WINDOW`` bytes (shorter
items are one window). A window with at most ``e`` edits against some stretch of a text
shares at least ``w + 1 - q - q * e`` q-grams with it, all on diagonals within ``e`` of one
another. So shared q-grams are counted per window in overlapping bands of diagonals; bands
that reach the bound are verified by banded alignment. A text with a verified window is
contaminated.

The index of the benchmark is broadcast in shards of at most ``SHARD_BYTES`` of item text;
a benchmark of more text is handled by one pass for each shard, so no broadcast grows.

Postings are looked at ``MOST_POSTINGS`` at a time: text and items are cut into stretches that
overlap by more than a window, and every match lies whole in one of them. So memory stays the
same for texts and items that repeat one q-gram over and over.

Defined results: null and empty texts have no matches; null or empty items are skipped; items
of under ``WORD_BOUND_BELOW`` bytes must stand between word bounds, and those of fewer than ``Q``
bytes must be there letter by letter; equal items each match; a text of any length is searched
whole; an empty benchmark contaminates nothing. Other columns are kept, one named ``leaks`` is
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import text_blocks

Q = 8
WINDOW = 80
STEP = 20
EDIT_SHARE = 0.075  # edits allowed in a window, as a share of its length
WORD_BOUND_BELOW = 40  # bytes of an item under which it could be a part of a word
MOST_POSTINGS = 1 << 18
REACH = WINDOW + int(EDIT_SHARE * WINDOW) + Q  # bytes of text that a match may take, and some
SHARD_BYTES = 8 << 20
FILTER_BITS = 22
_HASH = np.uint64(0x9E3779B97F4A7C15)

LEAKS = "array<struct<item_id:long,start:long,end:long,edits:int>>"
LEAKS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with case and white space folded, their offsets, and where each byte was."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[9:14] = 32
    out = table[data]
    keep = out != 32
    keep[1:] |= out[:-1] != 32
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    keep[firsts] = True
    origin = np.flatnonzero(keep)
    return out[origin], np.searchsorted(origin, offsets), origin


def grams(data: np.ndarray) -> np.ndarray:
    """The q-gram that begins at each byte, packed into 64 bits."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    pairs = (data[:-1].astype(np.uint64) << np.uint64(8)) | data[1:]
    fours = (pairs[:-2] << np.uint64(16)) | pairs[2:]
    return (fours[:-4] << np.uint64(32)) | fours[4:]


@dataclass
class BenchmarkIndex:
    """Windows of one shard of items, and where each q-gram stands in the items."""

    ids: np.ndarray  # of the items
    texts: list[bytes]
    window_item: np.ndarray
    window_start: np.ndarray
    window_length: np.ndarray
    window_edits: np.ndarray
    item_first_window: np.ndarray
    window_spot: np.ndarray  # where each window begins in all items
    begin: np.ndarray  # of each item in all items
    codes: np.ndarray  # distinct q-grams, sorted
    first: np.ndarray  # of each code's postings
    item: np.ndarray  # postings
    at: np.ndarray
    spot: np.ndarray  # code and place in all items of each posting, as one sorted number
    size: int  # of all items
    filter: np.ndarray
    tiny: list[tuple[int, bytes]]  # items too short for a q-gram

    @property
    def longest(self) -> int:
        return max(map(len, self.texts))

    @property
    def band(self) -> int:
        return int(self.window_edits.max()) + 1

    def parts(self) -> tuple:
        """All of it as plain values, which workers can read without this class."""
        return tuple(getattr(self, f.name) for f in fields(self))


def build_index(items: list[tuple[int, str]]) -> BenchmarkIndex | None:
    ids, texts, tiny = [], [], []
    for item_id, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        body = folded(raw, np.array([0, len(raw)]))[0].tobytes().strip() if len(raw) else b""
        if len(body) >= Q:
            ids.append(item_id)
            texts.append(body)
        elif body:
            tiny.append((item_id, body))
    if not ids and not tiny:
        return None
    windows, codes, item, at, first_window = [], [], [], [], [0]
    for i, body in enumerate(texts):
        length = min(WINDOW, len(body))
        starts = list(range(0, len(body) - length + 1, STEP))
        if starts[-1] != len(body) - length:
            starts.append(len(body) - length)
        # so many edits that the lemma still asks for one q-gram at least
        # equal windows of an item find the same stretches, so one of them is enough
        starts = sorted({body[s : s + length]: s for s in reversed(starts)}.values())
        windows += [(i, s, length, min(int(EDIT_SHARE * length), (length - Q) // Q)) for s in starts]
        first_window.append(len(windows))
        g = grams(np.frombuffer(body, np.uint8))
        used = np.zeros(len(g) + 1, np.int64)
        np.add.at(used, starts, 1)
        np.add.at(used, np.minimum(np.array(starts) + length - Q + 1, len(g)), -1)
        used = np.flatnonzero(np.cumsum(used)[:-1] > 0)
        codes.append(g[used])
        item.append(np.full(len(used), i))
        at.append(used)
    code = np.concatenate([*codes, np.zeros(0, np.uint64)])
    item, at = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (item, at))
    order = np.argsort(code, kind="stable")
    distinct, first = np.unique(code[order], return_index=True)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[(distinct * _HASH) >> np.uint64(64 - FILTER_BITS)] = True
    w = np.array(windows, np.int64).reshape(-1, 4)
    begin = np.cumsum([0] + [len(t) for t in texts])
    size = int(begin[-1])
    first = np.append(first, len(order))
    spot = np.repeat(np.arange(len(distinct)), np.diff(first)) * (size + 1) + begin[item[order]] + at[order]
    return BenchmarkIndex(
        np.array(ids, np.int64), texts, w[:, 0], w[:, 1], w[:, 2], w[:, 3], np.array(first_window), begin[w[:, 0]] + w[:, 1],
        begin, distinct, first, item[order], at[order], spot, size, seen, tiny,
    )


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, so many as its count."""
    total = int(counts.sum())
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(total)


def _candidates(index: BenchmarkIndex, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (text, window, lowest diagonal of a band) whose shared q-grams reach the lemma's bound."""
    none = np.zeros((0, 3), np.int64)
    code = grams(data)
    if not len(code) or not len(index.codes):
        return none
    at = np.flatnonzero(index.filter[(code * _HASH) >> np.uint64(64 - FILTER_BITS)])
    text = np.searchsorted(offsets, at, "right") - 1
    inside = at + Q <= offsets[text + 1]
    at, text = at[inside], text[inside]
    place = np.minimum(np.searchsorted(index.codes, code[at]), len(index.codes) - 1)
    hit = index.codes[place] == code[at]
    at, text, place = at[hit], text[hit], place[hit]
    so_far = np.cumsum(index.first[place + 1] - index.first[place])
    found, low = [none], 0
    while low < len(at):
        done = so_far[low - 1] if low else 0
        high = max(int(np.searchsorted(so_far, done + MOST_POSTINGS, "right")), int(np.searchsorted(at, at[low] + 2 * REACH)))
        found += _of_stretch(index, offsets, at[low:high], text[low:high], place[low:high], 0, index.size + 1)
        if high >= len(at):
            break
        low = int(np.searchsorted(at, at[high] - REACH))
    return np.unique(np.concatenate(found), axis=0)


def _of_stretch(index: BenchmarkIndex, offsets: np.ndarray, at: np.ndarray, text: np.ndarray, place: np.ndarray, begin: int, end: int) -> list[np.ndarray]:
    """Candidates from hits in a stretch of text with the items' bytes from ``begin`` to ``end``."""
    first = np.searchsorted(index.spot, place * (index.size + 1) + begin)
    counts = np.searchsorted(index.spot, place * (index.size + 1) + end) - first
    if counts.sum() > MOST_POSTINGS and end - begin > 4 * WINDOW:
        middle = (begin + end) // 2
        halves = ((begin, middle + WINDOW), (middle, end))
        return [c for half in halves for c in _of_stretch(index, offsets, at, text, place, *half)]
    post = _ranges(first, counts)
    if not len(post):
        return []
    at, text = np.repeat(at, counts), np.repeat(text, counts)
    item, pos = index.item[post], index.at[post]
    # each hit counts in the two bands that its diagonal lies in; a band with too few hits
    # for any window of its item goes before windows are looked at
    least = index.window_length + 1 - Q - Q * index.window_edits
    item_least = np.minimum.reduceat(least, index.item_first_window[:-1])
    band = (at - offsets[text] - pos + index.longest) // index.band
    bands = int(band.max()) + 2
    key = np.concatenate([(text * len(index.ids) + item) * bands + band + 1, (text * len(index.ids) + item) * bands + band])
    item, pos = np.tile(item, 2), np.tile(pos, 2)
    enough = _counts(key) >= item_least[item]
    key, item, pos = key[enough], item[enough], pos[enough]
    if not len(key):
        return []
    # and in each window that covers it; a q-gram of the item counts once
    from_window, spot = index.item_first_window[item], index.begin[item] + pos
    lowest = np.maximum(np.searchsorted(index.window_spot, spot + Q - index.window_length[from_window]), from_window)
    covering = np.maximum(np.searchsorted(index.window_spot, spot, "right") - lowest, 0)
    window = _ranges(lowest, covering)
    key, pos = np.repeat(key, covering), np.repeat(pos, covering)
    start = index.window_start[window]
    use = (pos >= start) & (pos + Q <= start + index.window_length[window])
    key, pos, window = key[use], pos[use], window[use]
    if not len(key):
        return []
    order = np.lexsort((pos, window, key))
    key, pos, window = key[order], pos[order], window[order]
    change = (key[1:] != key[:-1]) | (window[1:] != window[:-1])
    distinct = np.concatenate([[True], change | (pos[1:] != pos[:-1])])
    starts = np.concatenate([[0], np.flatnonzero(change) + 1])
    size = np.add.reduceat(distinct, starts)
    kept = starts[size >= least[window[starts]]]
    pair, band = key[kept] // bands, key[kept] % bands
    # band b holds diagonals from (b - 1) * width to (b + 1) * width - 1, less what keeps them positive
    return [np.stack([pair // len(index.ids), window[kept], (band - 1) * index.band - index.longest], axis=1)]


def _counts(keys: np.ndarray) -> np.ndarray:
    """For each entry at least how often its key occurs; more only where two keys share a slot."""
    slot = ((keys.astype(np.uint64) * _HASH) >> np.uint64(64 - 20)).astype(np.int64)
    return np.bincount(slot, minlength=1 << 20)[slot]


def _align(index: BenchmarkIndex, data: np.ndarray, offsets: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Rows (text, item, start, end, edits) of the candidates that hold; banded, all at once."""
    text, window, diagonal = found.T
    length, edits = index.window_length[window], index.window_edits[window]
    e, span = int(index.window_edits.max()), index.band
    # text positions of window byte j that its band allows: base + j + (0 .. width - 1)
    base = offsets[text] + index.window_start[window] + diagonal - e
    width = 2 * span + 2 * e
    padded = np.concatenate([data, np.zeros(1, np.uint8)])
    low, high = offsets[text], offsets[text + 1]
    letters = np.zeros((len(found), WINDOW), np.uint8)
    for i, (w, n) in enumerate(zip(window.tolist(), length.tolist())):
        s = index.window_start[w]
        letters[i, :n] = np.frombuffer(index.texts[index.window_item[w]], np.uint8)[s : s + n]
    columns = np.arange(width)
    big = 10_000
    cost = np.zeros((len(found), width), np.int32)  # row 0: begin anywhere in the band
    origin = base[:, None] + columns  # where the stretch of each cell began
    best, best_end, best_start = np.full(len(found), big), np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    for j in range(1, int(length.max()) + 1):
        at = base[:, None] + (j - 1) + columns  # the text byte that the diagonal step consumes
        within = (at >= low[:, None]) & (at < high[:, None])
        same = within & (padded[np.clip(at, 0, len(data))] == letters[:, j - 1 : j])
        across = np.where(within, cost + ~same, big)
        skip = np.full_like(cost, big)
        skip[:, :-1] = cost[:, 1:] + 1  # a window byte that the text lacks
        take = skip < across
        new = np.where(take, skip, across)
        first = np.empty_like(origin)
        first[:, :-1] = np.where(take[:, :-1], origin[:, 1:], origin[:, :-1])
        first[:, -1] = origin[:, -1]
        # text bytes that the window lacks: runs to the right, each costs one
        run = new - columns
        least = np.minimum.accumulate(run, axis=1)
        source = np.maximum.accumulate(np.where(run == least, columns, 0), axis=1)
        cost = np.minimum(least + columns, big).astype(np.int32)
        origin = np.take_along_axis(first, source, axis=1)
        done = np.flatnonzero(length == j)
        if len(done):
            k = cost[done].argmin(axis=1)
            best[done] = cost[done, k]
            best_end[done] = base[done] + j + k
            best_start[done] = origin[done, k]
    ok = best <= edits
    return np.stack([text[ok], index.window_item[window[ok]], best_start[ok], best_end[ok], best[ok]], axis=1)


def _word_letter(byte: int) -> bool:
    return byte >= 128 or chr(byte).isalnum()


def _stands_alone(body: bytes, data: np.ndarray, low: int, high: int, a: int, b: int) -> bool:
    """Whether no word goes on at either end of a match from a to b in the text from low to high."""
    before = a > low and _word_letter(body[0]) and _word_letter(int(data[a - 1]))
    after = b < high and _word_letter(body[-1]) and _word_letter(int(data[b]))
    return not before and not after


def _tiny_leaks(index: BenchmarkIndex, data: np.ndarray, offsets: np.ndarray):
    """Rows (text, item id, start, end) of items too short for a q-gram."""
    whole = data.tobytes() if index.tiny else b""
    for item_id, body in index.tiny:
        at = whole.find(body)
        while at >= 0:
            text = int(np.searchsorted(offsets, at, "right")) - 1
            low, high, end = int(offsets[text]), int(offsets[text + 1]), at + len(body)
            if end <= high and _stands_alone(body, data, low, high, at, end):
                yield text, item_id, at, end
            at = whole.find(body, at + 1)


def find_leaks_in(index: BenchmarkIndex, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[dict]]:
    """Leaks of each text of a block; windows of one item that overlap are one leak."""
    folds, starts, origin = folded(data, offsets)
    candidates = _candidates(index, folds, starts)
    leaks: dict[int, list[dict]] = {}
    for part in range(0, len(candidates), 4096):
        for text, item, a, b, edits in _align(index, folds, starts, candidates[part : part + 4096]):
            a, b = max(a, starts[text]), min(b, starts[text + 1])
            body = index.texts[item]
            if len(body) < WORD_BOUND_BELOW and not _stands_alone(body, folds, int(starts[text]), int(starts[text + 1]), int(a), int(b)):
                continue
            leak = {"item_id": int(index.ids[item]), "start": int(origin[a] - offsets[text]), "end": int(origin[b - 1] + 1 - offsets[text]), "edits": int(edits)}
            leaks.setdefault(int(text), []).append(leak)
    for text, item_id, a, b in _tiny_leaks(index, folds, starts):
        leaks.setdefault(text, []).append({"item_id": int(item_id), "start": int(origin[a] - offsets[text]), "end": int(origin[b - 1] + 1 - offsets[text]), "edits": 0})
    for text, rows in leaks.items():
        rows.sort(key=lambda r: (r["item_id"], r["start"], r["end"]))
        merged = rows[:1]
        for r in rows[1:]:
            last = merged[-1]
            if r["item_id"] == last["item_id"] and r["start"] <= last["end"]:
                last["end"], last["edits"] = max(last["end"], r["end"]), max(last["edits"], r["edits"])
            else:
                merged.append(r)
        leaks[text] = merged
    return leaks


def _shards(benchmark: DataFrame, shard_bytes: int) -> list[list[tuple[int, str]]]:
    """The items in shards of bounded text; only one shard's texts at a time are wanted later."""
    spark = benchmark.sparkSession
    items = benchmark.where(F.octet_length("text") > 0).select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // shard_bytes)
    shards = []
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        index = build_index(sorted((r["item_id"], r["text"]) for r in part.collect()))
        if index:
            shards.append(spark.sparkContext.broadcast(index.parts()))
    return shards


def find_leaks(docs: DataFrame, benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` plus ``leaks``: item and byte range in ``text`` of every contaminated stretch."""
    docs = docs.drop("leaks")
    at = docs.columns.index("text")

    def search(frame: DataFrame, shared) -> DataFrame:
        schema = frame.select("*").schema

        def run(batches):
            index = BenchmarkIndex(*shared.value)
            for batch in batches:
                for first, data, offsets in text_blocks(batch.column(at)):
                    n = len(offsets) - 1
                    found = find_leaks_in(index, data, offsets)
                    rows = batch.slice(first, n)
                    column = rows.column(rows.num_columns - 1)
                    if found:
                        before = column.to_pylist()
                        column = pa.array([before[i] + found.get(i, []) for i in range(n)], LEAKS_ARROW)
                    yield pa.RecordBatch.from_arrays([*rows.columns[:-1], column], schema.names)

        return frame.mapInArrow(run, schema)

    # one pass for each shard over the same rows; each adds what it finds
    return reduce(search, _shards(benchmark, shard_bytes), docs.withColumn("leaks", F.array().cast(LEAKS)))
