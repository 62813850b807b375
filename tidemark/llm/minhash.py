"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct five-word shingles. Each of ``PERMUTATIONS`` hash
functions gives two signature values, the minimum and the maximum over the set, so a
signature of 128 values costs 64 evaluations. Bands of four values put documents into
buckets: a pair at the threshold misses all 32 with a chance of 5 in a million.

Nothing in a bucket is paired with everything else. Equal sets become one representative
first. Then every member is verified against the bucket's smallest and largest id; what that
links is one component. Only members of different components that still share a bucket are
paired, where sizes and parity bitmaps allow the threshold, and verified on full sets. A
parity bitmap tells for every slot whether an odd number of the set's shingles fall into
it; two bitmaps differ in no more slots than the sets in shingles, so nothing is lost.

Defined results: words are what is between ASCII white space, A-Z lower-cased; a text of
fewer than five words is one shingle; null, empty and wordless texts have an empty set and
link with nothing. Rows with one id are one document (any of its texts may link). A row
without an id is alone in its component, which is null, and kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Words, byte_values, mix, noise, text_blocks, word_powers
from .graph import components, store

SHINGLE = 5
SIMILAR = 75  # percent
PERMUTATIONS = 64
BAND = 4
BANDS = 2 * PERMUTATIONS // BAND
PARITY_WORDS = 16  # 64-bit words of a set's parity bitmap

_SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, buckets array<long>"


def _values() -> np.ndarray:
    inside = np.ones(256, bool)
    inside[[32, *range(9, 14)]] = False
    return byte_values(inside)


def shingle_sets(column: pa.Array):
    """(row, sorted distinct shingle hashes) of every text of a column."""
    values, powers, factors = _values(), word_powers(), noise(SHINGLE + 1, 71)
    for first, data, offsets in text_blocks(column):
        words = Words(data, offsets, values, powers)
        h = words.hashes()
        with np.errstate(over="ignore"):
            rolled = sum(h[k : len(h) - SHINGLE + 1 + k] * factors[k] for k in range(SHINGLE)) if len(h) >= SHINGLE else h[:0]
            rolled = mix(rolled)
            for i in range(len(offsets) - 1):
                a, b = int(words.text_first[i]), int(words.text_first[i + 1])
                if b - a >= SHINGLE:
                    yield first + i, np.unique(rolled[a : b - SHINGLE + 1])
                elif b > a:
                    short = (h[a:b] * factors[: b - a]).sum(dtype=np.uint64) + factors[SHINGLE] * np.uint64(b - a)
                    yield first + i, mix(np.array([short]))
                else:
                    yield first + i, h[:0]


def signature(shingles: np.ndarray, factors: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of every permutation over a set that is not empty."""
    low, high = None, None
    with np.errstate(over="ignore"):
        for k in range(0, len(shingles), 2048):
            hashed = (shingles[k : k + 2048] ^ masks[:, None]) * factors[:, None]
            a, b = hashed.min(axis=1), hashed.max(axis=1)
            low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
    return np.concatenate([low, high])


def sketches(docs: DataFrame) -> DataFrame:
    """For each row the size and fingerprint of its set, and its buckets."""

    def run(batches):
        factors, masks, weights = noise(PERMUTATIONS, 101), noise(PERMUTATIONS, 103), noise(BAND, 107)
        numbers = noise(BANDS, 109)
        for batch in batches:
            n = batch.num_rows
            sizes, fixed = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64)
            buckets = np.zeros((n, BANDS), np.uint64)
            for i, shingles in shingle_sets(batch.column(1)):
                sizes[i] = len(shingles)
                if not len(shingles):
                    continue
                with np.errstate(over="ignore"):
                    values = signature(shingles, factors, masks)
                    fixed[i, 0] = mix(shingles).sum(dtype=np.uint64)
                    fixed[i, 1] = mix(shingles ^ numbers[0]).sum(dtype=np.uint64)
                    mixed = mix(values)
                    buckets[i] = mix((mixed.reshape(BANDS, BAND) * weights).sum(axis=1, dtype=np.uint64) + numbers)
            counts = np.where(sizes > 0, BANDS, 0)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(buckets[sizes > 0].ravel().view(np.int64)))
            columns = [batch.column(0), pa.array(sizes), *(pa.array(np.ascontiguousarray(fixed[:, k]).view(np.int64)) for k in range(2)), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_a", "set_b", "buckets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SKETCH)


def _full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, shingles, parity_*`` of the documents whose id is in ``ids``."""
    names = [f"parity_{k}" for k in range(PARITY_WORDS)]
    slots = PARITY_WORDS * 64

    def run(batches):
        for batch in batches:
            sets = [s for _, s in shingle_sets(batch.column(1))]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            parity = np.zeros((len(sets), slots), bool)
            for i, s in enumerate(sets):
                parity[i] = np.bincount((s >> np.uint64(7)).astype(np.int64) % slots, minlength=slots) & 1
            words = np.packbits(parity, axis=1).view(np.int64).reshape(len(sets), PARITY_WORDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), *(pa.array(np.ascontiguousarray(words[:, k])) for k in range(PARITY_WORDS))],
                ["doc_id", "shingles", *names],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    return rows.mapInArrow(run, "doc_id long, shingles array<long>, " + ", ".join(f"{n} long" for n in names))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where(both * 100 >= (F.size("x") + F.size("y") - both) * percent).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = SIMILAR) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, n_shingles, component_id, kept``."""
    every = store(sketches(docs), "sketches").df
    known = every.where("doc_id IS NOT NULL AND n_shingles > 0")
    key = ["set_a", "set_b", "n_shingles"]
    classes = known.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    reps = known.join(classes.withColumnRenamed("rep", "doc_id"), [*key, "doc_id"], "left_semi")
    rows = reps.select("doc_id", F.explode("buckets").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    members = store(rows.join(shared, "bucket"), "buckets").df
    sets = store(_full_sets(docs, members.select("doc_id").distinct()), "sets").df

    first = members.select(F.col("low").alias("a"), F.col("doc_id").alias("b")).union(members.select(F.col("doc_id").alias("a"), F.col("high").alias("b")))
    links = store(_verified(first.where("a < b").distinct(), sets, percent), "links").df
    found = components(links).select(F.col("id").alias("doc_id"), "component")

    # what shares a bucket but no component yet
    placed = members.join(found, "doc_id", "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    sizes = placed.groupBy("bucket", "component").count()
    home = sizes.groupBy("bucket").agg(F.max_by("component", "count").alias("home"), F.count("*").alias("n")).where("n > 1").drop("n")
    names = [f"parity_{k}" for k in range(PARITY_WORDS)]
    facts = sets.select("doc_id", F.size("shingles").alias("n"), *names)
    open_rows = store(placed.join(home, "bucket").join(facts, "doc_id"), "open").df
    stray = open_rows.where("component <> home").select(*[F.col(c).alias(f"{c}_l") for c in open_rows.columns if c not in ("bucket", "home")], "bucket")
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_l"))) for c in names), F.lit(0))
    # the sets may differ in (100 - percent) / (100 + percent) of their sizes' sum
    alike = (differ * (100 + percent) <= (F.col("n") + F.col("n_l")) * (100 - percent)) & (F.least("n", "n_l") * 100 >= F.greatest("n", "n_l") * percent)
    once = (F.col("component") == F.col("home")) | (F.col("doc_id_l") < F.col("doc_id"))
    rest = stray.join(open_rows, "bucket").where((F.col("component") != F.col("component_l")) & once & alike)
    rest = rest.select(F.least("doc_id", "doc_id_l").alias("a"), F.greatest("doc_id", "doc_id_l").alias("b")).distinct()
    more = _verified(rest.join(first, ["a", "b"], "left_anti"), sets, percent)
    groups = components(links.union(more)).select(F.col("id").alias("rep"), "component")

    placed = every.select("doc_id", *key).join(classes, key, "left").join(groups, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
