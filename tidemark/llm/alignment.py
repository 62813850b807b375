"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often.

Each text is encoded by a byte-level BPE (A, over a space and the text) and by a piece BPE with
byte fallback (B, which adds that space itself). Byte offsets where tokens of both end cut the
text into groups; an A token and a B token whose byte ranges overlap are linked.

Counts of id pairs over the corpus go through a minimal perfect hash. The first pass encodes
and aligns every text, keeps the token ids in the shared folder and writes each task's pair
counts. The distinct pairs are dealt into buckets of about ``BUCKET_PAIRS``; each bucket gets a
hash of its own (levels of bit arrays: a key alone at its bit is placed, the others go on), and
a pair's index is the rank of its bit. Counts are summed as dense vectors with one place per
index: tasks add their part of a bucket into a vector, vectors are added up in a tree. The
second pass aligns the kept token ids again and looks the counts up; the key stored at an index
is compared with the pair, so a pair never gets another one's count.

The second pass broadcasts the hash in shards of ``SHARD_PAIRS`` pairs (12 bytes a pair and some
bits, so about 55 MB), one at a time and one pass over the token ids for each; nothing broadcast
grows with the corpus. Distinct pairs cannot exceed the product of both vocabularies.

Texts are encoded in pieces of about ``PIECE`` characters, cut only at a single space between
two other characters, where neither tokenizer has a token that goes across (checked for the
pieces of B when its model is read). A text without such spaces is one piece; memory for a text
is some bytes per byte of it.

Defined results: a null or empty text, or one that either tokenizer does not spell out byte by
byte, has no tokens, so all its numbers are zero and its groups are empty text. Repeated rows and
rows without id are texts like others. Other columns are not carried along. An empty table gives
no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import mix
from .graph import Stored, store

PIECE = 1 << 16  # characters
BLOCK = 1 << 20  # characters aligned at once
HELD_PAIRS = 1 << 20  # distinct pairs a task counts before it hands them on
BUCKET_PAIRS = 1 << 16
SHARD_PAIRS = 1 << 22
LEAF_ROWS = 1 << 20
FAN_IN = 16
GAMMA = 2  # bits per key and level

# Fixed value: how a byte-level BPE of this kind splits text before its merges.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass
class Vocabularies:
    """Both tokenizers as files, and the bytes of every token by id."""

    json_a: str
    model_b: bytes
    bytes_a: list[bytes]
    bytes_b: list[bytes]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabularies(path_a: str, path_b: str) -> Vocabularies:
    """Read both files here; their contents travel, so workers need not have them."""
    with open(path_a, encoding="utf-8") as f:
        json_a = f.read()
    with open(path_b, "rb") as f:
        model_b = f.read()
    letters = _byte_letters()
    rules = json.loads(json_a)["model"]
    entries = rules["vocab"]
    # ids in the order of merges are what makes ranks and merges the same rule
    joined = ("".join(m) if isinstance(m, list) else m.replace(" ", "") for m in rules["merges"])
    if [entries[m] for m in joined] != list(range(256, 256 + len(rules["merges"]))):
        raise ValueError("merges are not in the order of the ids")
    bytes_a = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        bytes_a[i] = bytes(letters[c] for c in entry)
    model = sentencepiece.SentencePieceProcessor(model_proto=model_b)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("pieces that go across a space: texts cannot be cut at spaces")
    bytes_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Vocabularies(json_a, model_b, bytes_a, bytes_b)


def _blank(c: str) -> bool:
    return c.isspace() or c == "▁"  # B's own letter for a space


def pieces(text: str, size: int = PIECE) -> list[str]:
    """Parts that give the text when joined by single spaces; no part begins or ends at another white space."""
    out, first = [], 0
    while len(text) - first > size:
        at = text.find(" ", first + size)
        while at >= 0 and (at + 1 >= len(text) or _blank(text[at - 1]) or _blank(text[at + 1])):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[first:at])
        first = at + 1
    out.append(text[first:])
    return out


class Encoder:
    """Both tokenizers in a worker. The fast one's stack does not bear long runs, so long pieces take the other."""

    def __init__(self, vocabularies: Vocabularies):
        v = vocabularies
        self.v = v
        ranks = {b: i for i, b in enumerate(v.bytes_a) if b}
        self.fast = tiktoken.Encoding("a", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_proto=v.model_b)

    @cached_property
    def slow(self) -> tokenizers.Tokenizer:
        own = tokenizers.Tokenizer.from_str(self.v.json_a)
        own.encode_special_tokens = True
        return own

    def _a(self, piece: str) -> list[int]:
        if len(piece) > 2 * PIECE:
            return self.slow.encode(piece, add_special_tokens=False).ids
        return self.fast.encode_ordinary(piece)

    def encode(self, texts: list[str]) -> list[list[tuple[list[int], list[int]]]]:
        """Ids of both for each piece of each text; no pieces for a text that has no tokens."""
        parts = [pieces(t) if t else [] for t in texts]
        ids_b = iter(self.model.encode([p for ps in parts for p in ps], num_threads=1))
        a_of, b_of = self.v.bytes_a.__getitem__, self.v.bytes_b.__getitem__
        out = []
        for ps in parts:
            done, right = [], True
            for p in ps:
                a, b, wanted = self._a(" " + p), next(ids_b), (" " + p).encode("utf-8", "surrogatepass")
                right = right and b"".join(map(a_of, a)) == wanted and b"".join(map(b_of, b)) == wanted
                done.append((a, b))
            out.append(done if right else [])
        return out


class Links:
    """Tokens of texts laid end to end, and what is linked with what.

    ``ia``, ``ib``: the A and the B token of each link; ``common[k]``: a group ends with link k.
    ``text_links``: the first link of each text, and the end.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray, text_bytes: np.ndarray):
        ends_a, ends_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
        marks = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.uint8)
        marks[ends_a] = 1
        marks[ends_b] |= 2
        at = np.flatnonzero(marks)
        kinds = marks[at]
        self.common = kinds == 3
        ends = (kinds & 1).astype(np.int64)
        self.ia = np.cumsum(ends) - ends
        ends = (kinds >> 1).astype(np.int64)
        self.ib = np.cumsum(ends) - ends
        self.text_links = np.searchsorted(at, np.concatenate([[0], np.cumsum(text_bytes)]), "right")
        self.text_links[0] = 0


def _digits(n: int, mark: str) -> np.ndarray:
    return np.array([f"{i}{mark}" for i in range(n)], "S")


class GroupTexts:
    """Groups as ``a1,a2|b1;a3|b2,b3``: decimal ids in order."""

    def __init__(self, n_a: int, n_b: int):
        self.a, self.a_last, self.b, self.b_last = _digits(n_a, ","), _digits(n_a, "|"), _digits(n_b, ","), _digits(n_b, ";")
        self.kind = f"S{max(self.a.itemsize, self.b.itemsize)}"

    def render(self, a: np.ndarray, b: np.ndarray, links: Links) -> bytes:
        """Fixed-width bytes, one cell a token; zeros are padding."""
        last_a, last_b = links.ia[links.common], links.ib[links.common]
        group_a = np.searchsorted(last_a, np.arange(len(a)))
        group_b = np.searchsorted(last_b, np.arange(len(b)))
        first_b = np.concatenate([[0], last_b + 1])
        cells = np.zeros(len(a) + len(b), self.kind)
        place_a, place_b = np.arange(len(a)) + first_b[group_a], np.arange(len(b)) + last_a[group_b] + 1
        cells[place_a] = self.a[a]
        cells[place_a[last_a]] = self.a_last[a[last_a]]
        cells[place_b] = self.b[b]
        cells[place_b[last_b]] = self.b_last[b[last_b]]
        return cells


def _ids(values: list[list[int]]) -> np.ndarray:
    return np.concatenate([np.asarray(v, np.uint32) for v in values]) if values else np.zeros(0, np.uint32)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, at, np.concatenate(counts))
    return distinct, sums


_TOKENS = "doc_id long, a array<binary>, b array<binary>, pairs binary, n binary"


def _lengths(tokens: list[bytes]) -> np.ndarray:
    return np.array([len(t) for t in tokens], np.int64)


def encode_and_count(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """Rows of token ids, and among them rows (without ``a``) of the pairs a task has counted so far."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabularies.json_a, vocabularies.model_b, vocabularies.bytes_a, vocabularies.bytes_b))
    n_b = len(vocabularies.bytes_b)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("a", pa.list_(pa.binary())), ("b", pa.list_(pa.binary())), ("pairs", pa.binary()), ("n", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabularies(*shared.value))
        len_a, len_b = _lengths(encoder.v.bytes_a), _lengths(encoder.v.bytes_b)
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def counted(held_keys: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
            rows = [[None], [None], [None], [held_keys.tobytes()], [held.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(r, t.type) for r, t in zip(rows, schema)], schema=schema)

        for batch in batches:
            for ids, texts in _slices(batch):
                encoded = encoder.encode(texts)
                parts = [part for text in encoded for part in text]
                for some in _some(parts):
                    a, b = _ids([x for x, _ in some]), _ids([y for _, y in some])
                    links = Links(a, b, len_a, len_b, np.zeros(0, np.int64))
                    found, n = np.unique(a[links.ia].astype(np.int64) * n_b + b[links.ib], return_counts=True)
                    keys.append(found)
                    counts.append(n)
                if sum(map(len, keys)) > HELD_PAIRS:
                    keys, counts = ([x] for x in _merged(keys, counts))
                    if len(keys[0]) > HELD_PAIRS // 2:
                        yield counted(keys[0], counts[0])
                        keys, counts = [], []
                tokens = [[[np.array(part[k], np.uint32).astype(np.uint16 if top else np.uint32).tobytes() for part in text] for text in encoded] for k, top in ((0, len(len_a) <= 1 << 16), (1, n_b <= 1 << 16))]
                rows = [ids, *tokens, [None] * len(ids), [None] * len(ids)]
                yield pa.RecordBatch.from_arrays([pa.array(r, t.type) for r, t in zip(rows, schema)], schema=schema)
        if keys:
            yield counted(*_merged(keys, counts))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _TOKENS)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, about a block at a time."""
    ids, texts, first, held = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= BLOCK or i == len(texts) - 1:
            yield ids[first : i + 1], [t or "" for t in texts[first : i + 1]]
            first, held = i + 1, 0


def _some(parts: list) -> Iterator[list]:
    """Pieces, about a block at a time."""
    held: list = []
    size = 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= BLOCK // 2:
            yield held
            held, size = [], 0
    if held:
        yield held


# --- the minimal perfect hash ------------------------------------------------


def _slot(keys: np.ndarray, level: int, sizes: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = mix(keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019) * np.uint64(level + 1))
    return (h % np.asarray(sizes, np.uint64)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, bits of all levels (whole 64-bit words) and the keys in the order of their indexes."""
    sizes, parts, at, left, done = [], [], [], keys, 0
    ordered: list[np.ndarray] = []
    while len(left):
        size = GAMMA * len(left)
        slots = _slot(left, len(sizes), size)
        alone = np.bincount(slots, minlength=size)[slots] == 1
        bits = np.zeros(size, np.uint8)
        bits[slots[alone]] = 1
        sizes.append(size)
        parts.append(bits)
        at.append(done + slots[alone])
        ordered.append(left[alone])
        left, done = left[~alone], done + size
    bits = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    bits = np.concatenate([bits, np.zeros(-len(bits) % 64, np.uint8)])
    placed = np.concatenate(ordered) if ordered else keys
    return sizes, np.packbits(bits, bitorder="little").view(np.uint64), placed[np.argsort(np.concatenate(at))] if at else placed


class PerfectHash:
    """Indexes of keys over some buckets, whose bits lie one after the other."""

    def __init__(self, first_bucket: int, sizes: list[list[int]], bits: list[np.ndarray]):
        self.first = first_bucket
        depth = max(map(len, sizes), default=0)
        self.sizes = np.zeros((len(sizes), depth), np.int64)
        for i, own in enumerate(sizes):
            self.sizes[i, : len(own)] = own
        starts = np.cumsum([0] + [64 * len(b) for b in bits])[:-1]
        self.base = starts[:, None] + np.cumsum(self.sizes, axis=1) - self.sizes
        self.words = np.concatenate(bits) if bits else np.zeros(0, np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def index(self, keys: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """The index of each key; one that was never put in may get any index, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level in range(self.sizes.shape[1]):
            own = buckets[left] - self.first
            sizes = self.sizes[own, level]
            left, own, sizes = left[sizes > 0], own[sizes > 0], sizes[sizes > 0]
            at = self.base[own, level] + _slot(keys[left], level, sizes)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.before[at >> 6] + below)[hit]
            left = left[~hit]
        return out


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys.astype(np.uint64) + np.uint64(0xD1B54A32D192ED03)) % np.uint64(buckets)).astype(np.int64)


def _dealt(batches, buckets: int, salts: int) -> Iterator[pa.RecordBatch]:
    """Pair counts of tasks as rows ``bucket, salt, pair, n``."""
    for k, batch in enumerate(batches):
        for i, (pairs, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            keys = np.frombuffer(pairs, np.int64)
            salt = int(mix(np.array([int(keys[0]) + 31 * len(keys) + 7 * i + k], np.uint64))[0] % np.uint64(salts)) if len(keys) else 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket_of(keys, buckets)), pa.array(np.full(len(keys), salt)), pa.array(keys), pa.array(np.frombuffer(n, np.int64))],
                ["bucket", "salt", "pair", "n"],
            )


@dataclass
class PairCounts:
    """Counts of all id pairs: ``bucket, sizes, bits, pairs, counts`` in the shared folder, and each B id's highest."""

    table: Stored
    buckets: int
    distinct: int
    highest: np.ndarray


def count_pairs(partial: DataFrame, n_b: int) -> PairCounts:
    """One count for each distinct pair of ``partial`` (pairs, n: packed longs of a task)."""
    each = partial.mapInArrow(lambda batches: _dealt(batches, 1, 1), "bucket long, salt long, pair long, n long")
    sizes = each.agg(F.count("*").alias("rows"), F.approx_count_distinct("pair", 0.02).alias("pairs")).first()
    # a bucket is to hold about BUCKET_PAIRS, a leaf of the tree about LEAF_ROWS
    buckets = max(1, -(-sizes["pairs"] // BUCKET_PAIRS))
    salts = max(1, -(-sizes["rows"] // (buckets * LEAF_ROWS)))
    dealt = partial.mapInArrow(lambda batches: _dealt(batches, buckets, salts), "bucket long, salt long, pair long, n long")

    def hashed(group: pa.Table) -> pa.Table:
        own, bits, ordered = build_hash(np.sort(group.column("pair").to_numpy()))
        row = {"bucket": [group.column("bucket")[0].as_py()], "sizes": [own], "bits": [bits.tobytes()], "pairs": [ordered.astype(np.int64).tobytes()]}
        return pa.table(row, pa.schema([("bucket", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("pairs", pa.binary())]))

    hashes = store(
        dealt.select("bucket", "pair").distinct().groupBy("bucket").applyInArrow(hashed, "bucket long, sizes array<long>, bits binary, pairs binary"),
        "hashes",
    )

    def leaf(rows: pa.Table, of: pa.Table) -> pa.Table:
        ordered = np.frombuffer(of.column("pairs")[0].as_py(), np.int64)
        vector = np.zeros(len(ordered), np.int64)
        if rows.num_rows:
            keys = rows.column("pair").to_numpy()
            at = PerfectHash(0, [of.column("sizes")[0].as_py()], [np.frombuffer(of.column("bits")[0].as_py(), np.uint64)]).index(keys, np.zeros(len(keys), np.int64))
            if not np.array_equal(ordered[at], keys):
                raise ValueError("a pair is not where its hash says")
            np.add.at(vector, at, rows.column("n").to_numpy())
        return _vector(of.column("bucket")[0].as_py(), of.column("salt")[0].as_py(), vector)

    salted = hashes.df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1).cast("long"))))
    vectors = dealt.groupBy("bucket", "salt").cogroup(salted.groupBy("bucket", "salt")).applyInArrow(leaf, "bucket long, salt long, counts binary")
    while salts > 1:
        salts = -(-salts // FAN_IN)
        vectors = vectors.withColumn("salt", F.expr(f"salt div {FAN_IN}")).groupBy("bucket", "salt").applyInArrow(_summed, "bucket long, salt long, counts binary")
    table = store(hashes.df.join(vectors.drop("salt"), "bucket"), "pair-counts")
    hashes.drop()

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = np.zeros(n_b, np.int64)
        for batch in batches:
            for pairs, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                np.maximum.at(high, np.frombuffer(pairs, np.int64) % n_b, np.frombuffer(counts, np.int64))
        used = np.flatnonzero(high)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(high[used])], ["b", "n"])

    highest = np.zeros(n_b, np.int64)  # one number for each id of B, however large the corpus
    for row in table.df.select("pairs", "counts").mapInArrow(tops, "b long, n long").groupBy("b").agg(F.max("n").alias("n")).collect():
        highest[row["b"]] = row["n"]
    distinct = table.df.agg(F.sum(F.expr("octet_length(pairs) div 8"))).first()[0] or 0
    return PairCounts(table, buckets, distinct, highest)


def _vector(bucket: int, salt: int, vector: np.ndarray) -> pa.Table:
    return pa.table(
        {"bucket": [bucket], "salt": [salt], "counts": [vector.tobytes()]}, pa.schema([("bucket", pa.int64()), ("salt", pa.int64()), ("counts", pa.binary())])
    )


def _summed(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), np.int64) for v in group.column("counts"))
    return _vector(group.column("bucket")[0].as_py(), group.column("salt")[0].as_py(), total)


# --- the second pass ---------------------------------------------------------

_FOUND = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
_CARRIED = "doc_id long, a array<binary>, b array<binary>, n_best long, count_sum long"


def align(docs: DataFrame, path_a: str, path_b: str, shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of each text of ``docs`` (doc_id, text).

    ``n_best`` links have the highest count of their B id; ``count_sum`` adds up the counts of all
    links; ``groups`` reads ``a1,a2|b1;a3|b2,b3`` in decimal ids.
    """
    v = read_vocabularies(path_a, path_b)
    first = store(encode_and_count(docs, v), "tokens")
    counts = count_pairs(first.df.where("pairs IS NOT NULL").select("pairs", "n"), len(v.bytes_b))
    zero = F.lit(0).cast("long")
    state, held = first.df.where("pairs IS NULL").select("doc_id", "a", "b", zero.alias("n_best"), zero.alias("count_sum")), first
    step = max(1, shard_pairs // BUCKET_PAIRS)
    for low in range(0, counts.buckets, step):
        high = min(counts.buckets, low + step)
        if high == counts.buckets:
            return _looked_up(state, v, counts, low, high, last=True)
        rest = store(_looked_up(state, v, counts, low, high, last=False), "tokens")
        held.drop()
        state, held = rest.df, rest
    raise AssertionError("there is always a bucket")


def _looked_up(state: DataFrame, v: Vocabularies, counts: PairCounts, low: int, high: int, last: bool) -> DataFrame:
    """Adds the counts of links whose pair lies in the buckets from ``low`` to before ``high``."""
    n_b, buckets = len(v.bytes_b), counts.buckets
    found = {r["bucket"]: r for r in counts.table.df.where((F.col("bucket") >= low) & (F.col("bucket") < high)).collect()}
    rows = [found.get(i) for i in range(low, high)]
    keys = np.concatenate([np.frombuffer(r["pairs"], np.int64) if r else np.zeros(0, np.int64) for r in rows])
    shared = state.sparkSession.sparkContext.broadcast((
        [list(r["sizes"]) if r else [] for r in rows],
        [np.frombuffer(r["bits"], np.uint64) if r else np.zeros(0, np.uint64) for r in rows],
        keys.astype(np.uint32) if len(v.bytes_a) * n_b <= 1 << 32 else keys,
        np.concatenate([np.frombuffer(r["counts"], np.int64) if r else np.zeros(0, np.int64) for r in rows]),
        counts.highest, _lengths(v.bytes_a), _lengths(v.bytes_b),
    ))
    kinds = [np.uint16 if len(x) <= 1 << 16 else np.uint32 for x in (v.bytes_a, v.bytes_b)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, bits, held_keys, held_counts, highest, len_a, len_b = shared.value
        index = PerfectHash(low, sizes, bits)
        texts = GroupTexts(len(len_a), n_b) if last else None

        def looked_up(a: np.ndarray, b: np.ndarray, links: Links) -> tuple[np.ndarray, np.ndarray]:
            """The count of each link whose pair is in this shard (0 for others), and whether it is its B id's highest."""
            pair = a[links.ia].astype(np.int64) * n_b + b[links.ib]
            bucket = bucket_of(pair, buckets)
            mine = np.flatnonzero((bucket >= low) & (bucket < high))
            at = index.index(pair[mine], bucket[mine])
            if len(at) and (at.min() < 0 or not np.array_equal(held_keys[at].astype(np.int64), pair[mine])):
                raise ValueError("a pair of the second pass was not counted in the first")
            n = np.zeros(len(pair), np.int64)
            n[mine] = held_counts[at]
            return n, (n > 0) & (n == highest[b[links.ib]])

        def sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[edges[1:]] - total[edges[:-1]]

        for batch in batches:
            ids, tokens_a, tokens_b, best, total = (batch.column(k).to_pylist() for k in range(5))
            out: list[list] = [[], [], [], [], [], [], [], []]
            for group in _rows_of_about(tokens_a, tokens_b):
                parts = [(np.frombuffer(x, kinds[0]).astype(np.uint32), np.frombuffer(y, kinds[1]).astype(np.uint32), i) for i in group for x, y in zip(tokens_a[i], tokens_b[i])]
                per_text = {i: [0, 0, 0, 0, best[i], total[i], []] for i in group}
                for some in _some(parts):
                    a, b = _ids([x for x, _, _ in some]), _ids([y for _, y, _ in some])
                    lengths = np.array([int(len_a[x].sum()) for x, _, _ in some])
                    links = Links(a, b, len_a, len_b, lengths)
                    n, top = looked_up(a, b, links)
                    edges = links.text_links
                    cells = texts.render(a, b, links) if last else None
                    at = 0
                    for (x, y, i), n_groups, n_links, n_best, n_sum in zip(
                        some, sums(links.common, edges).tolist(), np.diff(edges).tolist(), sums(top, edges).tolist(), sums(n, edges).tolist()
                    ):
                        held = per_text[i]
                        for k, more in enumerate((len(x), len(y), n_groups, n_links, n_best, n_sum)):
                            held[k] += more
                        if last:
                            held[6].append(cells[at : at + len(x) + len(y)].tobytes().replace(b"\0", b""))
                            at += len(x) + len(y)
                for i in group:
                    held = per_text[i]
                    out[0].append(ids[i])
                    for k in range(6):
                        out[k + 1].append(held[k])
                    out[7].append(b"".join(held[6])[:-1].decode())
                if last and sum(map(len, out[7])) > 8 * BLOCK:
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:7]), pa.array(out[7], pa.string())], names)
                    out = [[], [], [], [], [], [], [], []]
            if last:
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:7]), pa.array(out[7], pa.string())], names)
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(out[5], pa.int64()), pa.array(out[6], pa.int64())], list(batch.schema.names)
                )

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return state.mapInArrow(run, _FOUND if last else _CARRIED)


def _rows_of_about(tokens_a: list, tokens_b: list) -> Iterator[list[int]]:
    """Row numbers, about a block of tokens at a time."""
    held, size = [], 0
    for i, (a, b) in enumerate(zip(tokens_a, tokens_b)):
        held.append(i)
        size += sum(map(len, a)) + sum(map(len, b))
        if size >= BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held
