"""Repeated substrings of 100 bytes over all documents, by sharded suffix sorting.

A byte goes if it is covered by a window of ``WINDOW`` bytes that also starts earlier: in a
document of smaller id, or further up in the same one. All is judged on the input.

Equal windows must meet in one shard wherever they come from. A window's key is the least
hash among its substrings of ``GRAM`` bytes, which depends on its bytes alone; neighbouring
windows mostly have one key, so a text falls into a few stretches per hundred bytes and only
these travel. Stretches of one key with equal bytes are settled by their order; the first of
each kind, where its key has several kinds, goes on to suffix sorting, dealt with its bytes
into shards of about ``SHARD_BYTES``. Keys that more than ``HOT_KEY`` stretches share are cut
by a second such hash first, which divides them between shards. Where the stretches of one
key have more than ``SHARD_BYTES``, a third hash cuts them into keys of their own; what still
has more, as around a passage that very many documents share, is compared window by window:
by 128 bits of hash, in joins instead of a shard. Each shard is sorted by external induced sorting
(``suffixes``); neighbours in that order that share ``WINDOW`` bytes are one group, and all
but its first window are repeats.

Defined results: null and empty texts, and texts under ``WINDOW`` bytes, lose nothing; equal rows
are one document; of several texts of one id the one with the least hash has that id's place, the
others are documents of their own that come after all ids below 2^62; rows without id
lose nothing and repeat nothing; other columns are kept, ones named like a result are
replaced; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import mix, text_blocks
from .graph import store
from .suffixes import prefix_hashes, suffix_order

WINDOW = 100
GRAM = 24
SHARD_BYTES = 1 << 20
HOT_KEY = 256  # stretches of one key from which on a second one divides them

# kind 0: a stretch to be compared; 1: one whose windows are all repeats; 2: one that may repeat itself
_STRETCH = "key long, inner long, doc_id long, at long, n int, kind int"
_FOUND = "doc_id long, at long, n int"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    return np.minimum(out[: len(out) - (width - reach)], out[width - reach :]) if width > reach else out


def window_keys(hashes, size: int, window: int, seed: int = 0) -> np.ndarray:
    """The least gram hash of every window of a block of ``size`` bytes, and the gram hashes."""
    grams = hashes(np.arange(size - GRAM + 1), GRAM)
    if seed:
        grams = mix(grams ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return _least(grams, window - GRAM + 1), grams


def _recurring(keys: np.ndarray, grams: np.ndarray, window: int) -> np.ndarray:
    """How many grams before each position are a window's least and recur within a window's length."""
    width = window - GRAM + 1
    padded = np.concatenate([np.zeros(width - 1, np.uint64), keys, np.zeros(width - 1, np.uint64)])
    least = np.flatnonzero(~_least(~padded, width) == grams)
    order = least[np.lexsort((least, grams[least]))]
    again = (grams[order[1:]] == grams[order[:-1]]) & (order[1:] - order[:-1] < width)
    counts = np.zeros(len(grams) + 1, np.int64)
    counts[order[:-1][again] + 1] = 1
    return np.cumsum(counts)


def _runs(keys: np.ndarray, valid: np.ndarray, text: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of valid windows with one key in one text, cut at ``longest``."""
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (keys[at[1:]] != keys[at[:-1]]) | (text[at[1:]] != text[at[:-1]])
    index = np.arange(len(at))
    origin = np.maximum.accumulate(np.where(new, index, 0))
    starts = np.flatnonzero((index - origin) % longest == 0)
    return at[starts], np.diff(np.append(starts, len(at)))


def _windows(offsets: np.ndarray, size: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Which window starts of a block stay in their text, and the text of each."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: size - window + 1]
    return np.arange(len(text)) + window <= offsets[text + 1], text


def _stretches(docs: DataFrame, window: int) -> DataFrame:
    """All stretches; of equal ones within a batch all but the first are repeats already."""

    def run(batches):
        for batch in batches:
            parts = []
            for first, data, offsets in text_blocks(batch.column(1)):
                if len(data) < window:
                    continue
                hashes = prefix_hashes(data)
                keys, grams = window_keys(hashes, len(data), window)
                valid, text = _windows(offsets, len(data), window)
                at, n = _runs(keys, valid, text, window - GRAM + 1)
                ids = batch.column(0).slice(first, len(offsets) - 1).to_numpy()
                inner = hashes(at, n + window - 1) ^ mix(n.astype(np.uint64))
                recurring = _recurring(keys, grams, window)
                kind = 2 * (recurring[at + n + window - GRAM] > recurring[at])
                parts.append((keys[at].view(np.int64), inner.view(np.int64), ids[text[at]], at - offsets[text[at]], n, kind))
            if not parts:
                continue
            columns = [np.concatenate(c) for c in zip(*parts)]
            order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
            key, inner, doc, at, n, kind = (c[order] for c in columns)
            same = np.zeros(len(key), bool)
            same[1:] = (key[1:] == key[:-1]) & (inner[1:] == inner[:-1])
            origin = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
            later = same & ((doc != doc[origin]) | (at != at[origin]))
            # what is settled needs no company, so it is dealt evenly
            key = np.where(later, mix(doc.view(np.uint64) ^ mix(at.astype(np.uint64))).view(np.int64), key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (key, inner, doc, at, n.astype(np.int32), np.where(later, 1, kind).astype(np.int32))], ["key", "inner", "doc_id", "at", "n", "kind"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, _STRETCH)


def _settle(stretches: DataFrame) -> DataFrame:
    """Repeats among equal stretches (kind 1), and the first of each kind of keys with several (kind 0).

    Rows come sorted by key and bytes; of a key, one row per kind is held back at most until
    a second kind shows up, so memory does not depend on how many share it.
    """

    def run(batches):
        last = None  # the last row: key, inner, and the first row of its kind
        held = None  # the only kind of the last key so far, not passed on yet
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if not batch.num_rows:
                continue
            key, inner, doc, at, n, kind = columns
            done = kind == 1
            keep = [np.stack([doc[done], at[done], n[done], np.ones(done.sum(), np.int64), key[done]])]
            key, inner, doc, at, n, kind = (c[~done] for c in (key, inner, doc, at, n, kind))
            if len(key):
                new_key = np.ones(len(key), bool)
                new_key[1:] = key[1:] != key[:-1]
                new_kind = new_key.copy()
                new_kind[1:] |= inner[1:] != inner[:-1]
                if last is not None and key[0] == last[0]:
                    new_key[0] = False
                    new_kind[0] = inner[0] != last[1]
                index = np.arange(len(key))
                origin = np.maximum.accumulate(np.where(new_kind, index, -1))
                first_doc = np.where(origin >= 0, doc[origin], last[2][0] if last else 0)
                first_at = np.where(origin >= 0, at[origin], last[2][1] if last else 0)
                later = ~new_kind & ((doc != first_doc) | (at != first_at))
                keep.append(np.stack([doc[later], at[later], n[later], np.ones(later.sum(), np.int64), key[later]]))
                # kinds of each key in this batch; a key begun before has its first kind in ``held`` or passed on
                group = np.cumsum(new_key)
                kinds = np.bincount(group, new_kind, group[-1] + 1)
                if not new_key[0]:
                    kinds[0] += 1
                if held is not None and (new_key[0] or kinds[0] > 1):
                    if not new_key[0]:
                        keep.append(held)
                    held = None
                row = np.stack([doc, at, n, np.zeros(len(key), np.int64), key])
                go = new_kind & ((kinds[group] > 1) | (kind == 2))
                # the last key may still get a second kind
                tail = group[-1]
                if kinds[tail] == 1 and new_key[group == tail].any():
                    held = row[:, np.flatnonzero(group == tail)[:1]]
                keep.append(row[:, go])
                o = origin[-1]
                last = (key[-1], inner[-1], (doc[o], at[o]) if o >= 0 else last[2])
            rows = np.concatenate(keep, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0]), pa.array(rows[1]), pa.array(rows[2].astype(np.int32)), pa.array(rows[3].astype(np.int32)), pa.array(rows[4])],
                ["doc_id", "at", "n", "kind", "key"],
            )

    return stretches.repartition("key").sortWithinPartitions("key", "inner", "doc_id", "at").mapInArrow(run, "doc_id long, at long, n int, kind int, key long")


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its count."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


def _large(stretches: DataFrame, window: int) -> DataFrame:
    """Keys whose stretches have more bytes than a shard should."""
    return stretches.groupBy("key").agg(F.sum(F.col("n") + window - 1).alias("bytes")).where(F.col("bytes") > SHARD_BYTES).select("key")


def _in_texts(docs: DataFrame, stretches: DataFrame, window: int, read, schema: str) -> DataFrame:
    """What ``read`` makes of each block's bytes: of its stretches the documents' ids, offsets, lengths and keys, and where they begin in the block."""
    lists = stretches.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n", "key")).alias("stretches"))
    rows = docs.join(lists, "doc_id")

    def run(batches):
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(1)):
                count = len(offsets) - 1
                lists = batch.column(2).slice(first, count)
                fields = lists.flatten()
                row = np.repeat(np.arange(count), np.diff(lists.offsets.to_numpy()))
                at, n, key = (fields.field(k).to_numpy() for k in range(3))
                # a stretch that does not fit is one of another text with the same id
                use = at + n + window - 1 <= np.diff(offsets)[row]
                if use.any():
                    ids = batch.column(0).slice(first, count).to_numpy()[row[use]]
                    yield from read(data, ids, at[use], n[use].astype(np.int64), key[use].view(np.uint64), (offsets[row] + at)[use])

    return rows.select("doc_id", "text", "stretches").mapInArrow(run, schema)


def _cut(docs: DataFrame, stretches: DataFrame, window: int) -> DataFrame:
    """``doc_id, at, n, key``: the stretches cut by a third key, which goes into their key."""

    def read(data, ids, at, n, key, begin):
        places, owner = _ranges(begin, n), np.repeat(np.arange(len(n)), n)
        third = window_keys(prefix_hashes(data), len(data), window, seed=2)[0][places]
        new = np.append(True, (owner[1:] != owner[:-1]) | (third[1:] != third[:-1]))
        starts = np.flatnonzero(new)
        own = owner[starts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[own]), pa.array(at[own] + places[starts] - begin[own]), pa.array(np.diff(np.append(starts, len(places))).astype(np.int32)),
                pa.array(mix(key[own] ^ mix(third[starts])).view(np.int64)),
            ],
            ["doc_id", "at", "n", "key"],
        )

    return _in_texts(docs, stretches, window, read, "doc_id long, at long, n int, key long")


def _repeated_windows(docs: DataFrame, stretches: DataFrame, window: int) -> DataFrame:
    """Windows of the stretches that are not the first of their kind, each by itself; no group of them is held anywhere."""

    def read(data, ids, at, n, key, begin):
        hashes, others = prefix_hashes(data), prefix_hashes(data ^ np.uint8(0x5A))
        step = max(1, 1_000_000 // int(n.max()))
        for k in range(0, len(n), step):
            part = slice(k, k + step)
            places = _ranges(begin[part], n[part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes(places, window).view(np.int64)), pa.array(others(places, window).view(np.int64)),
                    pa.array(np.repeat(ids[part], n[part])), pa.array(_ranges(at[part], n[part])),
                ],
                ["value", "check", "doc_id", "at"],
            )

    windows = _in_texts(docs, stretches, window, read, "value long, check long, doc_id long, at long")
    first = windows.groupBy("value", "check").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "at"))["at"].alias("first_at"), F.count("*").alias("rows"))
    later = windows.join(first.where("rows > 1"), ["value", "check"]).where("doc_id <> first_id OR at <> first_at")
    return later.select("doc_id", "at", F.lit(1).alias("n"))


def _pieces(docs: DataFrame, chosen: DataFrame, shards: int, window: int) -> DataFrame:
    """The chosen stretches with their bytes: ``shard, doc_id, at, n, text``; those of hot keys cut by a second key."""
    hot = chosen.groupBy("key").count().where(F.col("count") > HOT_KEY).select("key", F.lit(True).alias("hot"))
    marked = chosen.join(hot, "key", "left")
    lists = marked.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n", "key", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("stretches"))
    rows = docs.join(lists, "doc_id")

    def run(batches):
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(1)):
                count = len(offsets) - 1
                lists = batch.column(2).slice(first, count)
                sizes = np.diff(lists.offsets.to_numpy())
                fields = lists.flatten()
                row = np.repeat(np.arange(count), sizes)
                at, n, key = (fields.field(k).to_numpy() for k in range(3))
                hot = fields.field(3).to_numpy(zero_copy_only=False)
                # a stretch that does not fit is one of another text with the same id
                use = at + n + window - 1 <= (offsets[1:] - offsets[:-1])[row]
                row, at, n, key, hot = row[use], at[use], n[use].astype(np.int64), key[use].view(np.uint64), hot[use]
                if not len(row):
                    continue
                begin = offsets[row] + at
                places = _ranges(begin, n)
                owner = np.repeat(np.arange(len(row)), n)
                new = np.zeros(len(places), bool)
                new[np.cumsum(n) - n] = True
                inner = np.zeros(len(places), np.uint64)
                if hot.any():
                    second, _ = window_keys(prefix_hashes(data), len(data), window, seed=1)
                    cut = hot[owner]
                    inner[cut] = second[places[cut]]
                    new[1:] |= cut[1:] & (inner[1:] != inner[:-1])
                starts = np.flatnonzero(new)
                length = np.diff(np.append(starts, len(places)))
                own, place = owner[starts], places[starts]
                shard = (mix(key[own] ^ mix(inner[starts])) % np.uint64(shards)).astype(np.int64)
                size = length + window - 1
                for k in range(0, len(starts), 20_000):
                    part = slice(k, k + 20_000)
                    text = data[_ranges(place[part], size[part])]
                    bounds = np.concatenate([[0], np.cumsum(size[part])]).astype(np.int32)
                    texts = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(text)])
                    ids = batch.column(0).slice(first, count).to_numpy()[row[own[part]]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard[part]), pa.array(ids), pa.array(place[part] - offsets[row[own[part]]]), pa.array(length[part].astype(np.int32)), texts],
                        ["shard", "doc_id", "at", "n", "text"],
                    )

    return rows.select("doc_id", "text", "stretches").mapInArrow(run, "shard long, doc_id long, at long, n int, text binary")


def _repeats(pieces: DataFrame, window: int) -> DataFrame:
    """Runs of windows that are not the first of their kind in a shard."""

    def sort(table: pa.Table) -> pa.Table:
        doc, at, n = (table.column(c).to_numpy() for c in ("doc_id", "at", "n"))
        texts = table.column("text").combine_chunks()
        size = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]).astype(np.int64)
        data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
        begin = np.concatenate([[0], np.cumsum(size)])
        piece = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(data)) - begin[piece]
        order = suffix_order(data, window)
        order = order[inside[order] < n[piece[order]]]  # the others are no windows
        value = prefix_hashes(data)(order, window)
        same = np.zeros(len(order), bool)
        same[1:] = value[1:] == value[:-1]
        group = np.cumsum(~same)
        doc_of, at_of = doc[piece[order]], at[piece[order]] + inside[order]
        rank = np.lexsort((at_of, doc_of, group))
        g, d, a = group[rank], doc_of[rank], at_of[rank]
        origin = np.maximum.accumulate(np.where(np.append(True, g[1:] != g[:-1]), np.arange(len(g)), 0))
        later = (d != d[origin]) | (a != a[origin])
        d, a = d[later], a[later]
        if not len(d):
            return pa.table({"doc_id": doc[:0], "at": at[:0], "n": n[:0]})
        rank = np.lexsort((a, d))
        d, a = d[rank], a[rank]
        starts = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (a[1:] > a[:-1] + 1)))
        stops = np.append(starts[1:], len(d)) - 1
        return pa.table({"doc_id": d[starts], "at": a[starts], "n": (a[stops] - a[starts] + 1).astype(np.int32)})

    return pieces.groupBy("shard").applyInArrow(sort, _FOUND)


def removed_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, ranges``: starts and numbers of windows that repeat, for each document that has any."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= window))
    settled = store(_settle(_stretches(texts, window)), "stretches").df
    chosen = settled.where("kind = 0").select("doc_id", "at", "n", "key")
    found = settled.where("kind = 1").select("doc_id", "at", "n")
    large = store(_large(chosen, window), "large").df
    if not large.isEmpty():
        cut = store(_cut(texts, chosen.join(large, "key", "left_semi"), window), "cut").df
        still = store(_large(cut, window), "large").df
        chosen = chosen.join(large, "key", "left_anti").unionByName(cut.join(still, "key", "left_anti"))
        if not still.isEmpty():
            found = found.union(_repeated_windows(texts, cut.join(still, "key", "left_semi"), window))
    total = chosen.agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
    if total:
        found = found.union(_repeats(_pieces(texts, chosen, -(-total // SHARD_BYTES), window), window))
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("ranges"))


def _with_own_ids(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``_id``: the id, or for a further text of one id a number of its own above other ids."""
    text = F.xxhash64("text")
    several = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_of")).agg(F.min(text).alias("_first"), F.max(text).alias("_last"))
    several = store(several.where("_first <> _last"), "ids").df
    doc = F.col("doc_id").cast("long")
    own = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(doc, "text"), 2)
    joined = docs.join(several, doc == F.col("_of"), "left")
    return joined.select(*docs.columns, F.when(text != F.col("_first"), own).otherwise(doc).alias("_id"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` plus ``kept`` (the remaining bytes), ``n_removed`` and ``n_spans`` (maximal removed runs)."""
    docs = docs.drop("kept", "n_removed", "n_spans", "ranges", "_id", "_of")
    named = _with_own_ids(docs)
    ranges = removed_ranges(named.select(F.col("_id").alias("doc_id"), "text"), window).select(F.col("doc_id").alias("_of"), "ranges")
    rows = named.join(ranges, F.col("_id") == F.col("_of"), "left").drop("_id", "_of")
    schema = docs.select("*").schema.add("kept", "binary").add("n_removed", "long").add("n_spans", "long")
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(at)):
                n = len(offsets) - 1
                lists = batch.column(batch.num_columns - 1).slice(first, n)
                kept, removed, spans = [], [], []
                for i in range(n):
                    text = data[offsets[i] : offsets[i + 1]]
                    if not lists[i].is_valid:
                        kept.append(text.tobytes())
                        removed.append(0)
                        spans.append(0)
                        continue
                    values = lists[i].values
                    a = values.field(0).to_numpy()
                    b = np.minimum(a + values.field(1).to_numpy() + window - 1, len(text))
                    a = np.minimum(a, len(text))
                    depth = np.cumsum(np.bincount(a, minlength=len(text) + 1) - np.bincount(b, minlength=len(text) + 1))[:-1]
                    gone = depth > 0
                    kept.append(text[~gone].tobytes())
                    removed.append(int(gone.sum()))
                    spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                columns = [c.slice(first, n) for c in batch.columns[:-1]]
                columns += [pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)
