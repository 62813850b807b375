"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a probability (a logistic function of its
words and word beginnings); the document's is their noisy-or, one minus the product of the
sentences' complements. Weights are trained from labels of documents alone, and the
trained model then tells which sentences offend.

Defined results: null, empty and wordless texts have no sentence and score 0; where no label
of both kinds exists, every score is 0. Several labels of a document count once, as their
largest. Repeated rows are scored one by one; other columns are kept, ones named like a
result are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import Words, byte_values, noise, text_blocks, word_powers

BITS = 18
PREFIXES = (4, 5, 6)  # bytes of a word's beginning that are features of their own
SENTENCE_WORDS = 40  # longer sentences are judged in stretches of so many words
SAMPLE_ROWS = 6000  # most documents that weights are trained on, of each label half of them
LEAST_SEEN = 5  # sample documents that must hold a feature


def _word_bytes() -> np.ndarray:
    letters = np.zeros(256, bool)
    letters[65:91] = letters[97:123] = letters[128:] = True
    return letters


def _sentence_starts(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """The first word of every sentence of a block, in order."""
    ends = np.zeros(len(data) + 1, np.int32)
    ends[1:] = np.cumsum(np.isin(data, np.frombuffer(b".!?\n", np.uint8)))
    text = np.searchsorted(offsets, words.start, "right")
    number = ends[words.start]
    first = np.ones(len(words.start), bool)
    first[1:] = (number[1:] != number[:-1]) | (text[1:] != text[:-1])
    at = np.arange(len(first))
    origin = np.maximum.accumulate(np.where(first, at, 0))
    return np.flatnonzero((at - origin) % SENTENCE_WORDS == 0)


class _Block:
    """Features of a block: ``ids`` (features by words), the sentences' and the texts' first entries."""

    def __init__(self, data, offsets, values, powers, salts):
        words = Words(data, offsets, values, powers)
        lengths = words.end - words.start
        with np.errstate(over="ignore"):
            whole = ((words.hashes() * salts[0]) >> np.uint64(64 - BITS)).astype(np.int64)
            ids = [whole]
            for k, length in enumerate(PREFIXES, 1):
                part = ((words.hashes(length) * salts[k]) >> np.uint64(64 - BITS)).astype(np.int64)
                ids.append(np.where(lengths > length, part, 1 << BITS))  # the last entry stands for none
        self.words, self.ids = words, np.stack(ids)
        self.sentences = _sentence_starts(data, offsets, words)
        self.text_first = np.searchsorted(self.sentences, words.text_first)


def _blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, _Block]]:
    values, powers, salts = byte_values(_word_bytes()), word_powers(), noise(1 + len(PREFIXES), 41)
    for first, data, offsets in text_blocks(column):
        yield first, offsets, _Block(data, offsets, values, powers, salts)


@dataclass
class ToxicityModel:
    weights: np.ndarray  # one more than the features: none weighs 0
    bias: float

    def survival(self, block: _Block) -> np.ndarray:
        """log(1 - probability) of each sentence of a block."""
        if not len(block.sentences):
            return np.zeros(0)
        z = np.add.reduceat(self.weights[block.ids].sum(axis=0, dtype=np.float64), block.sentences) + self.bias
        return -np.logaddexp(0, z)


def _per_text(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    return sums[firsts[1:]] - sums[firsts[:-1]]


def _sample(docs: DataFrame, labels: DataFrame, bound: int) -> tuple[DataFrame | None, dict[int, int]]:
    """Features of at most ``bound`` labelled documents, and how many labels of each kind there are."""
    marked = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None, counts
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = [marked.where(F.col("toxic") == y).orderBy(*order).limit(bound // 2) for y in (0, 1)]
    # bounded by the parameter, so broadcasting it is safe and the texts need no shuffle
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(picked[0].union(picked[1])), "doc_id")
    # a label counts once, with the least text of its id
    chosen = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def features(batches):
        for batch in batches:
            for first, _, block in _blocks(batch.column(0)):
                n = len(block.text_first) - 1
                word_sentence = np.zeros(block.ids.shape[1], np.int64)
                word_sentence[block.sentences] = 1
                word_sentence = np.cumsum(word_sentence) - 1
                rows = []
                for i in range(n):
                    a, b = block.words.text_first[i], block.words.text_first[i + 1]
                    ids = block.ids[:, a:b]
                    pairs = np.unique((word_sentence[a:b] - block.text_first[i]) << 32 | ids)
                    pairs = pairs[(pairs & 0xFFFFFFFF) < 1 << BITS]
                    rows.append(np.bincount(pairs >> 32).astype(np.int32).tobytes())
                    rows.append((pairs & 0xFFFFFFFF).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(first, n), batch.column(2).slice(first, n), pa.array(rows[::2], pa.binary()), pa.array(rows[1::2], pa.binary())],
                    ["toxic", "doc_id", "lengths", "feature"],
                )

    return chosen.select("text", "toxic", "doc_id").mapInArrow(features, "toxic int, doc_id long, lengths binary, feature binary"), counts


def fit(rows: list, counts: dict[int, int], steps: int = 80, rate: float = 0.5, l2: float = 0.3, damping: float = 0.02, pull: float = 0.1) -> ToxicityModel:
    """Maximum likelihood of document labels under the noisy-or, by steps scaled per weight.

    ``damping``, by the number of documents, keeps steps of rare features small and ``l2`` their weights, so a few
    documents cannot make a rare word offensive, nor excuse a common one.
    """
    feature = [np.frombuffer(r["feature"], np.int32) for r in rows]
    seen = np.bincount(np.concatenate([np.unique(f) for f in feature]), minlength=(1 << BITS) + 1)
    kept, sentence, bag, base = [], [], [], 0
    for i, r in enumerate(rows):
        lengths, f = np.frombuffer(r["lengths"], np.int32), feature[i]
        n = len(lengths)
        use = seen[f] >= LEAST_SEEN
        kept.append(f[use])
        sentence.append(np.repeat(np.arange(base, base + n, dtype=np.int32), lengths)[use])
        bag.append(np.full(n, i, np.int32))
        base += n
    names = np.flatnonzero(seen >= LEAST_SEEN)
    place = np.zeros(len(seen), np.int32)
    place[names] = np.arange(len(names))
    f = place[np.concatenate(kept)]
    s, bag = np.concatenate(sentence), np.concatenate(bag)
    y = np.array([r["toxic"] for r in rows])
    weight = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum()))
    weight = weight / weight.mean()
    w, b, gw = np.zeros(len(names)), -6.0, np.full(len(names), damping * len(rows))
    for _ in range(steps):
        z = np.bincount(s, w[f], base) + b
        p = 1 / (1 + np.exp(-z))
        whole = -np.expm1(-np.bincount(bag, np.logaddexp(0, z), len(rows)))
        whole = np.clip(whole, 1e-9, 1)
        # derivative of the loss by a sentence's logit
        d = (weight * np.where(y == 1, -(1 - whole) / whole, 1.0))[bag] * p
        dw = np.bincount(f, d[s], len(names)) + l2 * w
        gw += dw * dw
        w -= rate * dw / np.sqrt(gw)
        # the bias goes where both labels pull alike: what pulls down is in proportion to its exponential
        b -= np.clip(pull * np.log((d[d > 0].sum() + 1e-9) / (-d[d < 0].sum() + 1e-9)), -0.2, 0.2)
    weights = np.zeros((1 << BITS) + 1, np.float32)
    weights[names] = w
    return ToxicityModel(weights, float(b))


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> ToxicityModel | None:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); None without both labels."""
    sample, counts = _sample(docs, labels.select("doc_id", "toxic"), bound)
    if sample is None:
        return None

    def learn(batches):
        """The whole sample, which the parameter bounds, in one task: the driver gets the model alone."""
        rows = [r for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["toxic"], r["feature"]))
        if {r["toxic"] for r in rows} == {0, 1}:
            model = fit(rows, counts)
            yield pa.RecordBatch.from_arrays([pa.array([model.bias]), pa.array([model.weights.tobytes()])], ["bias", "weights"])

    found = sample.repartition(1).mapInArrow(learn, "bias double, weights binary").collect()
    return ToxicityModel(np.frombuffer(found[0]["weights"], np.float32), found[0]["bias"]) if found else None


def score(docs: DataFrame, model: ToxicityModel | None, sentences: bool = False) -> DataFrame:
    """``docs`` plus ``toxicity`` and, on request, ``offending``: byte ranges of sentences over one half."""
    docs = docs.drop("toxicity", "offending")
    schema = docs.select("*").schema.add("toxicity", "double")
    if sentences:
        schema = schema.add("offending", T.ArrayType(T.StructType().add("start", "long").add("end", "long").add("score", "double")))
    at = docs.columns.index("text")
    # of fixed size; as plain values, so that workers need not know the class
    shipped = docs.sparkSession.sparkContext.broadcast(None if model is None else (model.weights, model.bias))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def predict(batches):
        model = None if shipped.value is None else ToxicityModel(*shipped.value)
        for batch in batches:
            for first, offsets, block in _blocks(batch.column(at)):
                n = len(offsets) - 1
                logs = model.survival(block) if model else np.zeros(len(block.sentences))
                found = np.clip(-np.expm1(_per_text(logs, block.text_first)), 0.0, 1.0)
                columns = [*batch.slice(first, n).columns, pa.array(found, pa.float64())]
                if sentences:
                    columns.append(pa.array(_offending(logs, offsets, block), kind))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(predict, schema)


def _offending(logs: np.ndarray, offsets: np.ndarray, block: _Block) -> list[list[dict]]:
    last = np.append(block.sentences[1:], block.ids.shape[1]) - 1
    p = -np.expm1(logs)
    rows = []
    for i in range(len(offsets) - 1):
        a, b = block.text_first[i], block.text_first[i + 1]
        rows.append([
            {"start": int(block.words.start[block.sentences[k]] - offsets[i]), "end": int(block.words.end[last[k]] - offsets[i]), "score": float(p[k])}
            for k in range(a, b) if p[k] >= 0.5
        ])
    return rows
