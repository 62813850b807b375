"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to ``MAX_N``-grams of the lower-cased text (what is no letter counts as one
kind of space) are hashed to ``DIMENSIONS`` features. Document frequencies come from every
training document; weights are trained by follow-the-regularised-leader with an elastic-net
penalty on a bounded sample, and one temperature is fitted on a part of the sample that
training did not see.

Defined results: a null text, or one without any letter, is ``und`` with score 0; where no
language can be learned (no training rows), every text is ``und``. Repeated rows are scored
one by one. Rows without a language are never trained on. Other columns are kept; ones named
like a result are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, noise

BITS = 15
DIMENSIONS = 1 << BITS
MAX_N = 3
SAMPLE_ROWS = 4000  # most documents that weights are trained on, all languages together
UNKNOWN = "und"


def _folding() -> np.ndarray:
    """Letters below U+3000 as they are, everything else there as a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x3000)], np.uint32)


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _texts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Each batch in slices of about a block of text."""
    for batch in batches:
        texts, first, held = batch.column(at).to_pylist(), 0, 0
        for i, text in enumerate(texts):
            held += len(text or "")
            if held >= BLOCK_BYTES or i == len(texts) - 1:
                yield batch.slice(first, i + 1 - first), texts[first : i + 1]
                first, held = i + 1, 0


def _feature_counts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """Features and their counts of each text; None where there is no letter."""
    folding, factors = _folding(), noise(8, 5).astype(np.uint32)
    lowered = [(t or "").lower() for t in texts]
    lengths = np.array([len(t) for t in lowered], np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < 0x3000, folding[np.minimum(points, 0x2FFF)], points)
    hashed = []
    with np.errstate(over="ignore"):
        for n in range(1, MAX_N + 1):
            h = np.full(max(0, len(points) - n + 1), n, np.uint32)
            for k in range(n):
                h += points[k : k + len(h)] * (factors[k] | np.uint32(1))
            h = (h ^ (h >> np.uint32(15))) * factors[7]
            hashed.append((h >> np.uint32(32 - BITS)).astype(np.int32))
    stop = np.cumsum(lengths)
    for text, a, b in zip(texts, (stop - lengths).tolist(), stop.tolist()):
        if text is None or not _has_letter(text):
            yield None
            continue
        parts = [h[a : max(a, b - n)] for n, h in enumerate(hashed)]
        counts = np.bincount(np.concatenate(parts), minlength=DIMENSIONS)
        used = np.flatnonzero(counts)
        yield used, counts[used]


def _weighted(used: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[used]
    norm = np.sqrt(x @ x)
    return (x / norm if norm else x).astype(np.float32)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features by languages; mostly zero
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _weighted(used, counts, self.idf) @ self.weights[used] + self.bias


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts hold each feature, and how many have a letter; over all rows."""

    def count(batches):
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for _, block in _texts(batches, 0):
            for features in _feature_counts(block):
                if features is not None:
                    seen[features[0]] += 1
                    n += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(seen[used], n), pa.int64())], ["feature", "n"]
        )

    rows = texts.select("text").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    frequencies, n = np.zeros(DIMENSIONS, np.int64), 0
    for feature, seen in rows:
        if feature < 0:
            n = seen
        else:
            frequencies[feature] = seen
    return frequencies, n


def _sample(training: DataFrame, bound: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """At most ``bound`` documents as features, about as many of each language, chosen by hash."""
    counts = {r["lang"]: r["count"] for r in training.groupBy("lang").count().collect()}
    if not counts:
        return []
    share = max(1, bound // len(counts))
    whole = 1 << 32
    order = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(whole))
    edges = {lang: int(min(1.0, share / n) * whole) for lang, n in counts.items()}
    edge = F.create_map(*[F.lit(x) for pair in edges.items() for x in pair])[F.col("lang")]
    # rows of one id share their hash: of these the least text counts, so no id fills the sample
    near = training.withColumn("_order", order).where(F.col("_order") < edge)
    chosen = near.groupBy("doc_id", "lang", "_order").agg(F.min("text").alias("text")).select("text", "lang", "_order")

    def features(batches):
        for batch, block in _texts(batches, 0):
            rows = [
                (lang, order, f[0].astype(np.int32).tobytes(), f[1].astype(np.int32).tobytes())
                for f, lang, order in zip(_feature_counts(block), batch.column(1).to_pylist(), batch.column(2).to_pylist())
                if f is not None
            ]
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary(), pa.binary()))],
                ["lang", "order", "used", "counts"],
            )

    found = chosen.mapInArrow(features, "lang string, order long, used binary, counts binary")
    rows = found.orderBy("order", "lang", "used").limit(bound).collect()  # so many at most reach the driver
    rows.sort(key=lambda r: (r["order"], r["lang"], bytes(r["used"])))
    return [(r["lang"], np.frombuffer(r["used"], np.int32), np.frombuffer(r["counts"], np.int32)) for r in rows]


def follow_the_leader(
    xs: list[tuple[np.ndarray, np.ndarray]], ys: np.ndarray, classes: int,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.5, epochs: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of multinomial logistic regression, one document at a time.

    The leader's closed form keeps a weight at exactly zero until its gradients add up to
    more than ``l1``; ``l2`` shrinks the rest. The bias has no penalty.
    """
    z, n = np.zeros((DIMENSIONS + 1, classes), np.float32), np.zeros((DIMENSIONS + 1, classes), np.float32)

    def leader(at):
        zs, lam = z[at], np.where(at == DIMENSIONS, 0.0, l1).astype(np.float32)[:, None]
        shrink = np.where(at == DIMENSIONS, 0.0, l2).astype(np.float32)[:, None]
        w = -(zs - np.sign(zs) * lam) / ((beta + np.sqrt(n[at])) / alpha + shrink)
        w[np.abs(zs) <= lam] = 0
        return w

    for _ in range(epochs):
        for (used, x), y in zip(xs, ys):
            at, value = np.append(used, DIMENSIONS), np.append(x, np.float32(1))
            w = leader(at)
            p = value @ w
            p = np.exp(p - p.max())
            p /= p.sum()
            p[y] -= 1
            g = value[:, None] * p
            squared = g * g
            z[at] += g - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / alpha * w
            n[at] += squared
    full = leader(np.arange(DIMENSIONS + 1))
    return full[:-1], full[-1]


def fit_temperature(logits: np.ndarray, ys: np.ndarray) -> float:
    """The divisor of the logits under which the held-back documents are likeliest."""
    best = (np.inf, 1.0)
    for t in np.geomspace(0.05, 20, 121):
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(ys)), ys]))
        best = min(best, (loss, float(t)))
    return best[1]


def train(training: DataFrame, bound: int = SAMPLE_ROWS) -> LanguageModel | None:
    """A model from ``doc_id, text, lang``; None where nothing can be learned."""
    training = training.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequencies, n = document_frequencies(training)
    sample = _sample(training, bound)
    if not sample:
        return None
    idf = (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float32)
    languages = sorted({s[0] for s in sample})
    index = {lang: i for i, lang in enumerate(languages)}
    ys = np.array([index[s[0]] for s in sample])
    xs = [(used, _weighted(used, counts, idf)) for _, used, counts in sample]
    held = np.arange(len(xs)) % 5 == 4
    weights, bias = follow_the_leader(
        [x for x, h in zip(xs, held) if not h], ys[~held], len(languages)
    )
    model = LanguageModel(languages, idf, weights, bias)
    if held.any():
        logits = np.array([x @ weights[used] + bias for (used, x), h in zip(xs, held) if h])
        model.temperature = fit_temperature(logits, ys[held])
    return model


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` (whole, with ``text``) plus ``lang_pred`` and ``score``."""
    docs = docs.drop("lang_pred", "score")
    schema = docs.select("*").schema.add("lang_pred", "string").add("score", "double")
    at = docs.columns.index("text")
    # of fixed size: features by languages; as plain values, so that workers need not know the class
    parts = None if model is None else (model.languages, model.idf, model.weights, model.bias, model.temperature)
    shipped = docs.sparkSession.sparkContext.broadcast(parts)

    def predict(batches):
        model = None if shipped.value is None else LanguageModel(*shipped.value)
        for batch, block in _texts(batches, at):
            found, scores = [], []
            for features in _feature_counts(block):
                if features is None or model is None:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                s = model.logits(*features) / model.temperature
                p = np.exp(s - s.max())
                best = int(p.argmax())
                found.append(model.languages[best])
                scores.append(float(p[best] / p.sum()))
            columns = [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(predict, schema)
