"""Line deduplication by a segment-partition edit join.

A line (what is between line feeds, trimmed) is dropped if an earlier one, by document id
and then by line number, is equal to it or within ``EDITS`` edits of it (UTF-8 bytes). Equal
lines count at any length; edits only between lines of ``EDIT_BYTES`` or more, as two edits
turn a shorter line into another one. Empty lines stay.

Equal lines become one distinct line first. A distinct line long enough is cut into ``EDITS + 1``
segments; of two lines within so many edits, one has a segment that the other holds
unchanged. Segments are indexed by the line's length, the segment's number and its bytes;
each line probes the indexes of its own and slightly smaller lengths at the few places
where a match can still be part of a good alignment. Pairs that meet are verified with a
banded bit-parallel edit distance, many pairs at once.

A segment that very many lines share (a common passage) is no evidence: there the remainder
of both lines is cut and probed in the same way, so both keys must agree.

Defined results: null texts stay null and empty ones empty; the first occurrence of every
line stays, so no document set loses a line altogether; rows with one id are taken as one
document, whose equal lines further down all count as later ones; lines at one line number of
rows with one id (repeated rows, say) have one place, so they stay or go together; documents without id
keep every line; other columns are kept as they are, ``n_chars`` follows the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import mix, noise, text_blocks
from .graph import store

EDITS = 2
LEAST_BYTES = 1  # of a line that is compared at all: only empty ones are not
EDIT_BYTES = 24  # of a line that is compared up to edits
HOT_SEGMENT = 64  # distinct lines behind one index key from which remainders are compared too
FILTER_SLOTS = 1 << 24
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)

# ``mark`` is the line's hash, its last bit whether the row probes
_KEYS = "key long, mark long"
_BAGGED = "key long, mark long, bag long"
_MET = "a long, b long, key long, mark long"


class _Hashes:
    """Hashes of any substring of a block, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        with np.errstate(over="ignore"):
            power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(_BASE))]), dtype=np.uint64)
            self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(_INVERSE))]), dtype=np.uint64)
            self.sums = np.zeros(n, np.uint64)
            np.cumsum(noise(256, 53)[data] * power[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[start + length] - self.sums[start]) * self.inverse[start]


def _segment(length: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the i-th of ``edits + 1`` even segments, the longer ones last."""
    n = edits + 1
    short, longer = length // n, length % n
    start = i * short + np.maximum(0, i - (n - longer))
    return start, short + (i >= n - longer)


def segment_keys(data: np.ndarray, offsets: np.ndarray, edits: int, salt: np.ndarray):
    """(line, key, whether it probes, segment start, segment length) of a block's lines, as arrays."""
    hashes, number = _Hashes(data), noise(64, 59)
    first, size = offsets[:-1], np.diff(offsets)
    every = np.arange(len(size))

    def key(lines: np.ndarray, indexed: np.ndarray, i: int, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            segment = mix(hashes.of(first[lines] + at, length) + number[i])
            return mix(segment ^ (indexed.astype(np.uint64) * number[63]) ^ salt[lines])

    for i in range(edits + 1):
        start, length = _segment(size, i, edits)
        use = (size > edits) & (length > 0)
        yield every[use], key(every[use], size[use], i, start[use], length[use]), False, start[use], length[use]
        for shorter in range(edits + 1):
            indexed = size - shorter
            start, length = _segment(np.maximum(indexed, 0), i, edits)
            # left of the segment at most i edits, right of it the rest of them
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                at = start + shift
                use = (indexed > edits) & (length > 0) & (at >= 0) & (at + length <= size)
                yield every[use], key(every[use], indexed[use], i, at[use], length[use]), True, at[use], length[use]


def bags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, which of 64 slots an odd number of its byte pairs falls into.

    An edit takes away at most two pairs and adds two, so texts within e edits differ in 4 e slots at most.
    """
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(n, np.uint64)
    first, text = data[:-1], np.repeat(np.arange(n), np.diff(offsets))
    slot = (first.astype(np.int64) * 31 + data[1:] * 7) & 63
    inside = text[1:] == text[:-1]
    odd = np.bincount((text[:-1] * 64 + slot)[inside], minlength=n * 64) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64)


def _bytes_block(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def within_edits(lefts: list[bytes], rights: list[bytes], edits: int) -> np.ndarray:
    """Which pairs are within ``edits``; one machine word per pair holds the band's column."""
    out = np.zeros(len(lefts), bool)
    sizes = np.array([(len(a), len(b)) for a, b in zip(lefts, rights)]).reshape(-1, 2)
    order = np.argsort(sizes.max(axis=1), kind="stable")
    for k in range(0, len(order), 2048):
        part = order[k : k + 2048]
        out[part] = _banded([lefts[i] for i in part], [rights[i] for i in part], edits)
    return out


def _banded(lefts: list[bytes], rights: list[bytes], edits: int) -> np.ndarray:
    """Vertical deltas of a band of 2 * edits + 1 rows around the diagonal, column by column.

    Bit d of a word is row ``column + d - edits``. The score follows the lower edge of the
    band down to the last row, then the last row to the last column.
    """
    one, width = np.uint64(1), 2 * edits + 1
    all_bits, top = np.uint64((1 << width) - 1), np.uint64(1 << (width - 1))
    x, xo = _bytes_block(lefts)
    y, yo = _bytes_block(rights)
    m, n = np.diff(xo), np.diff(yo)
    x, y = np.append(x, np.uint8(0)), np.append(y, np.uint8(0))
    # column 0: every row from 1 on goes up by one, what lies above row 1 is flat
    up = np.full(len(m), ((1 << (edits + 1)) - 1) << edits, np.uint64)
    down = np.zeros(len(m), np.uint64)
    score = np.full(len(m), edits, np.int64)
    edge = np.full(len(m), width - 2, np.int64)
    for j in range(int(n.max(initial=0))):
        live = j < n
        letter = y[np.minimum(yo[:-1] + j, len(y) - 1)]
        equal = np.zeros(len(m), np.uint64)
        for d in range(width):
            r = j + d - edits
            if r < 0:
                continue
            same = (r < m) & (x[np.minimum(xo[:-1] + r, len(x) - 1)] == letter)
            equal |= same.astype(np.uint64) << np.uint64(d)
        diagonal = ((((equal & up) + up) ^ up) | equal | down) & all_bits
        right_up = (down | ~(diagonal | up)) & all_bits
        right_down = diagonal & up
        falling = live & (j + edits < m)
        score += falling & ((diagonal & top) == 0)
        level = live & ~falling
        bit = one << np.maximum(edge, 0).astype(np.uint64)
        score += level & ((right_up & bit) != 0)
        score -= level & ((right_down & bit) != 0)
        edge -= level
        shifted = diagonal >> one
        new_up = (right_down | ~(shifted | right_up)) & all_bits
        new_down = shifted & right_up
        up, down = np.where(live, new_up, up), np.where(live, new_down, down)
    return (score <= edits) & (np.abs(m - n) <= edits)


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, whole, no, line``: the trimmed lines that are not empty, ``whole`` a hash of their text."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("whole"), F.posexplode(F.split("text", "\n", -1)).alias("no", "raw")
    )
    return rows.select("doc_id", "whole", "no", F.btrim("raw", F.lit(" \t\r")).alias("line")).where(F.octet_length("line") >= LEAST_BYTES)


def _identity() -> list[Column]:
    """128 bits of a line; of the first hash, the last bit is left free for a mark."""
    return [F.xxhash64("line").bitwiseAND(F.lit(-2)).alias("line_id"), F.xxhash64(F.lit(7), "line").alias("check")]


def _keyed(lines: DataFrame, edits: int) -> DataFrame:
    """Index and probe rows of every line; equal lines of one task are keyed once."""

    def run(batches):
        seen = np.zeros(0, np.int64)
        for batch in batches:
            ids, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            new = ~np.isin(ids, seen, assume_unique=True)
            seen = np.concatenate([seen, ids[new]])
            batch = batch.take(pa.array(np.sort(first[new])))
            for start, data, offsets in text_blocks(batch.column(1)):
                own = batch.column(0).slice(start, len(offsets) - 1).to_numpy()
                for rows, key, probe, _, _ in segment_keys(data, offsets, edits, np.zeros(len(own), np.uint64)):
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(own[rows] | probe)], ["key", "mark"])

    return lines.select(_identity()[0], "line").mapInArrow(run, _KEYS)


def _meet(keyed: DataFrame, limit: int | None, edits: int = EDITS) -> DataFrame:
    """Pairs of lines with an index and a probe row of one key; all rows of a key with too many lines.

    Where rows carry a bag of their line, pairs whose bags differ too much are left out.

    The rows come sorted by key, so one key is at hand at a time; of a key beyond the limit
    no pair is made, its rows are passed on as they come.
    """

    def pairs(keys, marks, bags):
        """Pairs of whole groups, held as arrays."""
        bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        size = np.diff(bounds)
        probes = np.add.reduceat(marks & 1, bounds[:-1]) if len(size) else size
        hot = size > limit * 2 if limit else np.zeros(len(size), bool)
        open_ = (probes > 0) & (probes < size) & ~hot
        # the rows of small groups, each against the ones that follow at a growing distance
        rows = np.repeat(open_, size)
        k, m, g = keys[rows], marks[rows], bags[rows]
        a, b, step = [], [], 1
        while step < len(k):
            same = k[step:] == k[:-step]
            if not same.any():
                break
            x, y = m[:-step][same], m[step:][same]
            use = ((x ^ y) & 1 == 1) & (x >> 1 != y >> 1) & (np.bitwise_count(g[:-step][same] ^ g[step:][same]) <= 4 * edits)
            a.append(np.minimum(x[use], y[use]) & -2)
            b.append(np.maximum(x[use], y[use]) & -2)
            step += 1
        rows = np.repeat(hot & (probes > 0) & (probes < size), size)
        return np.concatenate([*a, keys[:0]]), np.concatenate([*b, keys[:0]]), keys[rows], marks[rows]

    def batch_of(a, b, key, mark):
        if len(a):
            a, b = np.unique(np.stack([a, b], axis=1), axis=0).T
        n, none = len(a), len(key)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(a, np.zeros(none, np.int64)), mask=np.append(np.zeros(n, bool), np.ones(none, bool))),
                pa.array(np.append(b, np.zeros(none, np.int64)), mask=np.append(np.zeros(n, bool), np.ones(none, bool))),
                pa.array(np.append(np.zeros(n, np.int64), key)), pa.array(np.append(np.zeros(n, np.int64), mark)),
            ],
            ["a", "b", "key", "mark"],
        )

    def run(batches):
        keys = marks = bags = np.zeros(0, np.int64)
        for batch in batches:
            k, m = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            g = batch.column(2).to_numpy() if batch.num_columns > 2 else np.zeros(len(k), np.int64)
            keys, marks, bags = np.append(keys, k), np.append(marks, m), np.append(bags, g)
            if not len(keys):
                continue
            # equal rows come from equal lines of several tasks
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (marks[1:] != marks[:-1])])
            keys, marks, bags = keys[new], marks[new], bags[new]
            last = np.searchsorted(keys, keys[-1])  # the last group may go on
            yield batch_of(*pairs(keys[:last], marks[:last], bags[:last])) if last else batch_of(*[keys[:0]] * 4)
            keys, marks, bags = keys[last:], marks[last:], bags[last:]
        if len(keys):
            yield batch_of(*pairs(keys, marks, bags))

    return keyed.repartition("key").sortWithinPartitions("key", "mark").mapInArrow(run, _MET)


def _remainders(hot: DataFrame, edits: int) -> DataFrame:
    """Keys of what is left of lines (``key, mark, line``) without the segment of ``key``, and bags of whole lines."""

    def run(batches):
        for batch in batches:
            for start, data, offsets in text_blocks(batch.column(2)):
                keys = batch.column(0).slice(start, len(offsets) - 1).to_numpy()
                marks = batch.column(1).slice(start, len(offsets) - 1).to_numpy()
                texts, salts, owners, held, bag = [], [], [], [], bags(data, offsets).view(np.int64)
                for rows, key, probe, at, length in segment_keys(data, offsets, edits, np.zeros(len(keys), np.uint64)):
                    for r in np.flatnonzero((key.view(np.int64) == keys[rows]) & ((marks[rows] & 1) == probe)):
                        i = rows[r]
                        text = data[offsets[i] : offsets[i + 1]].tobytes()
                        texts.append(text[: at[r]] + text[at[r] + length[r] :])
                        salts.append(keys[i])
                        owners.append(marks[i])
                        held.append(bag[i])
                if not texts:
                    continue
                flat, bounds = _bytes_block(texts)
                owners, held = np.array(owners), np.array(held)
                for rows, key, probe, _, _ in segment_keys(flat, bounds, edits, mix(np.array(salts).view(np.uint64))):
                    # a probing line probes with its remainder, an indexed one is indexed with it
                    use = (owners[rows] & 1) == probe
                    yield pa.RecordBatch.from_arrays([pa.array(key[use].view(np.int64)), pa.array(owners[rows][use]), pa.array(held[rows][use])], ["key", "mark", "bag"])

    return hot.select("key", "mark", "line").mapInArrow(run, _BAGGED)


def _close(pairs: DataFrame, edits: int) -> DataFrame:
    """Those rows whose ``left`` and ``right`` are within ``edits``."""
    at = [pairs.columns.index(c) for c in ("left", "right")]

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                texts = [[t.encode() for t in part.column(i).to_pylist()] for i in at]
                found = np.bitwise_count(bags(*_bytes_block(texts[0])) ^ bags(*_bytes_block(texts[1]))) <= 4 * edits
                near = np.flatnonzero(found)
                found[near] = within_edits(*([t[i] for i in near] for t in texts), edits)
                yield part.filter(pa.array(found))

    return pairs.mapInArrow(run, pairs.select("*").schema)


def _bitmap(ids: DataFrame, name: str) -> np.ndarray:
    """Which of ``FILTER_SLOTS`` slots the ids of a column fall into; of fixed size at any number of ids."""
    slot = F.pmod(F.xxhash64(name), F.lit(FILTER_SLOTS))
    words = ids.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")
    )
    out = np.zeros(FILTER_SLOTS // 64, np.int64)
    for word, bits in words.collect():
        out[word] = bits
    return out


def duplicate_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``doc_id, whole, no`` of every line to drop; ``whole`` is the hash of the text it stands in."""
    lines = _lines(docs)
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("no").cast("decimal(10,0)")
    marked = lines.select("doc_id", "whole", "no", *_identity(), place.cast("decimal(38,0)").alias("place"))
    facts = store(marked.groupBy("line_id", "check").agg(F.min("place").alias("first"), F.count("*").alias("n")), "lines").df

    long = lines.where(F.octet_length("line") >= EDIT_BYTES)
    met = store(_meet(_keyed(long, edits), HOT_SEGMENT), "met").df
    hot = met.where("a IS NULL").select("key", "mark")
    pairs = met.where("a IS NOT NULL").select("a", "b")
    hot_lines = hot.select(F.col("mark").bitwiseAND(F.lit(-2)).alias("line_id"))
    wanted = pairs.select(F.col("a").alias("line_id")).union(pairs.select("b")).union(hot_lines).distinct()
    texts = store(_texts_of(long, facts.join(wanted, "line_id", "left_semi").select("line_id", "check", "first")), "texts").df
    more = hot.withColumn("line_id", F.col("mark").bitwiseAND(F.lit(-2))).join(texts.select("line_id", "line"), "line_id")
    again = _meet(_remainders(more, edits), None, edits).where("a IS NOT NULL").select("a", "b")

    left = texts.select(F.col("line_id").alias("a"), F.col("check").alias("check_a"), F.col("first").alias("first_a"), F.col("line").alias("left"))
    right = texts.select(F.col("line_id").alias("b"), F.col("check").alias("check_b"), F.col("first").alias("first_b"), F.col("line").alias("right"))
    links = _close(pairs.union(again).distinct().join(left, "a").join(right, "b"), edits)
    later = F.col("first_a") > F.col("first_b")
    losers = links.select(
        F.when(later, F.col("a")).otherwise(F.col("b")).alias("line_id"), F.when(later, F.col("check_a")).otherwise(F.col("check_b")).alias("check")
    ).distinct()
    judged = facts.join(losers.withColumn("lost", F.lit(True)), ["line_id", "check"], "left").where("n > 1 OR lost")
    return marked.join(judged, ["line_id", "check"]).where("lost OR place > first").select("doc_id", "whole", "no")


def _texts_of(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """``line_id, check, first, line`` of the wanted lines, each once.

    A bitmap of fixed size keeps most other lines out of the shuffle; the join decides.
    """
    bitmap = lines.sparkSession.sparkContext.broadcast(_bitmap(wanted, "line_id"))

    def run(batches):
        seen = np.zeros(0, np.int64)
        for batch in batches:
            slot = batch.column(3).to_numpy()
            hit = (bitmap.value[slot >> 6] >> (slot & 63)) & 1 == 1
            rows = np.flatnonzero(hit)
            ids, first = np.unique(batch.column(0).to_numpy()[rows], return_index=True)
            new = ~np.isin(ids, seen, assume_unique=True)
            seen = np.concatenate([seen, ids[new]])
            yield batch.take(pa.array(rows[np.sort(first[new])])).select([0, 1, 2])

    slot = F.pmod(F.xxhash64("line_id"), F.lit(FILTER_SLOTS)).alias("slot")
    rows = lines.select(*_identity(), "line").select("*", slot).mapInArrow(run, "line_id long, check long, line string")
    return wanted.join(rows.dropDuplicates(["line_id", "check"]), ["line_id", "check"])


def dedup_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``docs`` without later duplicates of lines: same columns, ``text`` (and ``n_chars``) changed, plus ``_dropped``."""
    docs = docs.drop("_dropped", "_id", "_whole")
    drops = duplicate_lines(docs, edits).distinct().groupBy("doc_id", "whole").agg(F.collect_list("no").alias("_dropped"))
    keys = drops.select(F.col("doc_id").alias("_id"), F.col("whole").alias("_whole"), "_dropped")
    joined = docs.join(keys, (F.col("doc_id").cast("long") == F.col("_id")) & (F.xxhash64("text") == F.col("_whole")), "left").drop("_id", "_whole")
    at, chars = joined.columns.index("text"), joined.columns.index("n_chars") if "n_chars" in joined.columns else None

    def run(batches):
        for batch in batches:
            dropped = batch.column(batch.num_columns - 1)
            if dropped.null_count == len(dropped):
                yield batch
                continue
            texts, changed = batch.column(at).to_pylist(), {}
            for i, numbers in enumerate(dropped.to_pylist()):
                if numbers:
                    gone = set(numbers)
                    texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone)
                    changed[i] = len(texts[i])
            columns = batch.columns
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if chars is not None:
                counts = columns[chars].to_pylist()
                for i, n in changed.items():
                    counts[i] = n
                columns[chars] = pa.array(counts, batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return joined.mapInArrow(run, joined.select("*").schema)
