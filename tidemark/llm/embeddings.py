"""Near-duplicate embeddings by counting collisions on one-dimensional projections.

Each of several tables has one sorted projection and a few more projections cut at zero,
which say in which cell of the table a vector lies (two vectors fall on one side of a cut
with a chance that depends on their angle alone, so recall holds for any distribution). Inside a cell the vectors are
sorted by the table's projection, and a query-centred window of calibrated width tells who
collides. The collisions of a pair are counted over all tables; pairs with at least
``LEAST_COLLISIONS`` are verified by cosine in double precision. The number of tables
follows from the recall asked for at the threshold, the number of cuts from the number of
vectors, so that cells stay about as large at any size.

A pair is looked at in the first table where it collides and nowhere else, so links need no
removal of repeats, and a block gives back one row per linked vector (a count and a root),
never its pairs. A cell of many vectors is split into salted blocks, each pair of blocks a
task of its own. Equal vectors become one representative first.

Defined results: vectors that are null, empty or zero, or hold null or non-finite values,
link with nothing; vectors of different length never link; rows without an id are alone,
with a null component, and kept; rows that repeat an id and a vector count as one vector
each in ``n_links``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, store

SIMILAR = 0.9
RECALL = 0.999  # of pairs exactly at the threshold; closer ones are surer
LEAST_COLLISIONS = 2
CELL_ROWS = 256  # what a cell is meant to hold
BLOCK_ROWS = 1024  # what a block of a larger cell holds
WINDOW = 2.5  # half-width in standard deviations of a threshold pair's difference

_VECTORS = "vec_id long, good boolean, key_a long, key_b long, size int, unit array<double>"


def _unit_vectors(batches):
    """Each row with its vector at length one and a 128-bit key of it."""
    for batch in batches:
        ids, out = batch.column(0), []
        for values in batch.column(1).to_pylist():
            x = None
            if values and None not in values:
                x = np.array(values, np.float64)
                top = np.abs(x).max()
                # scaled first, so that squares neither overflow nor vanish
                x = x / top if np.isfinite(x).all() and top > 0 else None
            if x is None:
                out.append((False, 0, 0, 0, None))
                continue
            x = x / np.sqrt(x @ x)
            key = np.frombuffer(hashlib.blake2b(np.array(values, np.float64).tobytes(), digest_size=16).digest(), np.int64)
            out.append((True, int(key[0]), int(key[1]), len(x), x))
        columns = list(zip(*out)) or [[]] * 5
        kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], ["vec_id", "good", "key_a", "key_b", "size", "unit"]
        )


def _normal_within(x: float) -> float:
    return math.erf(x / math.sqrt(2))


def plan_tables(n: int, similar: float, recall: float = RECALL) -> tuple[int, int]:
    """(cuts per table, tables) for n vectors."""
    cuts = max(0, round(math.log2(max(1, n / CELL_ROWS))))
    same_side = 1 - math.acos(similar) / math.pi
    q = same_side**cuts * _normal_within(WINDOW)
    tables = LEAST_COLLISIONS
    while tables < 4096:
        missed = sum(math.comb(tables, k) * q**k * (1 - q) ** (tables - k) for k in range(LEAST_COLLISIONS))
        if missed <= 1 - recall:
            break
        tables += 1
    return cuts, tables


class Projections:
    """The same random directions everywhere, for vectors of one length."""

    def __init__(self, size: int, cuts: int, tables: int, similar: float):
        rng = np.random.default_rng(size * 1009 + cuts * 31 + tables)
        self.cut = rng.standard_normal((size, tables * cuts))
        self.line = rng.standard_normal((size, tables))
        self.cuts, self.tables = cuts, tables
        self.width = WINDOW * math.sqrt(2 - 2 * similar)

    @classmethod
    def of_parts(cls, parts: dict) -> Projections:
        """One from another's attributes."""
        own = cls.__new__(cls)
        vars(own).update(parts)
        return own

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells and positions of vectors, each vectors by tables."""
        above = (x @ self.cut > 0).reshape(len(x), self.tables, self.cuts)
        cells = above @ (1 << np.arange(self.cuts, dtype=np.int64)) if self.cuts else np.zeros((len(x), self.tables), np.int64)
        return cells, x @ self.line


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable over the edges i-j, for each of n."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _block_links(x: np.ndarray, ids: np.ndarray, left: np.ndarray, right: np.ndarray, table: int, proj: Projections, similar: float):
    """Pairs (positions) of left and right rows that link and collide in this table first."""
    cells, at = proj.of(x)
    found_i, found_j = [], []
    right = right[np.argsort(at[right, table], kind="stable")]
    places = at[right, table]
    for k in range(0, len(left), 256):
        part = left[k : k + 256]
        part = part[np.argsort(at[part, table], kind="stable")]
        # only this stretch of the sorted projection lies in any of the windows
        a = np.searchsorted(places, at[part[0], table] - proj.width)
        b = np.searchsorted(places, at[part[-1], table] + proj.width, "right")
        other = right[a:b]
        if not len(other):
            continue
        count = np.zeros((len(part), len(other)), np.uint16)
        first = np.full(count.shape, proj.tables, np.uint16)
        for t in range(proj.tables):
            hit = (cells[part, t][:, None] == cells[other, t]) & (np.abs(at[part, t][:, None] - at[other, t]) <= proj.width)
            count += hit
            if t <= table:
                first[hit & (first == proj.tables)] = t
        i, j = np.nonzero((count >= LEAST_COLLISIONS) & (first == table) & (ids[part][:, None] != ids[other]))
        if len(i):
            near = np.einsum("ij,ij->i", x[part[i]], x[other[j]]) >= similar
            found_i.append(part[i[near]])
            found_j.append(other[j[near]])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (none, none)


def _links(reps: DataFrame, n: int, size: int, similar: float) -> DataFrame:
    """``rep, linked, root`` once per block and linked representative (vectors of one length)."""
    spark = reps.sparkSession
    cuts, tables = plan_tables(n, similar)
    # vector length by tables; as plain values, so that workers need not know the class
    shipped = spark.sparkContext.broadcast(vars(Projections(size, cuts, tables, similar)))

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, size)
            cells, _ = Projections.of_parts(shipped.value).of(x)
            rows = np.repeat(np.arange(batch.num_rows), tables)
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(tables, dtype=np.int32), batch.num_rows)), pa.array(cells.ravel()), *taken.columns],
                ["t", "cell", "rep", "copies", "unit"],
            )

    placed = reps.select("rep", "copies", "unit").mapInArrow(place, "t int, cell long, rep long, copies long, unit array<double>")
    # how many salted blocks a cell needs; a cell is one block unless it is large
    held = reps.select("rep", "copies", "unit").mapInArrow(place, placed.schema).groupBy("t", "cell").count()
    blocks = held.where("count > 1").select("t", "cell", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("k"))
    salted = placed.join(blocks, ["t", "cell"]).withColumn("mine", F.pmod(F.xxhash64("rep"), "k").cast("int"))
    dealt = salted.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    dealt = dealt.withColumn("block", F.least("mine", "other") * F.col("k") + F.greatest("mine", "other"))

    def link(key, batch):
        table, k, block = int(key[0].as_py()), int(key[2].as_py()), int(key[3].as_py())
        low, high = divmod(block, k)
        ids, copies = batch.column("rep").to_numpy(), batch.column("copies").to_numpy()
        x = batch.column("unit").combine_chunks().flatten().to_numpy().reshape(len(ids), size)
        order = np.argsort(ids, kind="stable")
        ids, copies, x, mine = ids[order], copies[order], x[order], batch.column("mine").to_numpy()[order]
        left, right = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
        i, j = _block_links(x, ids, left, right, table, Projections.of_parts(shipped.value), similar)
        if low == high:  # each pair was met from both sides
            i, j = i[i < j], j[i < j]
        linked = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        used = np.flatnonzero(linked)
        root = _roots(len(ids), i, j)
        return pa.table({"rep": ids[used], "linked": linked[used].astype(np.int64), "root": ids[root[used]]})

    return dealt.groupBy("t", "cell", "k", "block").applyInArrow(link, "rep long, linked long, root long")


def near_duplicates(vectors: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    every = store(rows.mapInArrow(_unit_vectors, _VECTORS), "vectors").df
    key = ["key_a", "key_b", "size"]
    good = every.where("good AND vec_id IS NOT NULL")
    classes = store(good.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes").df
    unique = good.select(*key, "vec_id", "unit").join(classes.withColumnRenamed("rep", "vec_id"), [*key, "vec_id"]).select(F.col("vec_id").alias("rep"), "copies", "size", "unit")
    reps = store(unique.dropDuplicates(["rep"]), "reps").df
    found = None
    for size, n in sorted(reps.groupBy("size").count().collect()):
        part = _links(reps.where(F.col("size") == size), n, size, similar)
        found = part if found is None else found.union(part)
    if found is None:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = store(found, "links").df
    counts = links.groupBy("rep").agg(F.sum("linked").alias("linked"))
    groups = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))).select(F.col("id").alias("rep"), "component")
    placed = every.join(classes, key, "left").join(counts, "rep", "left").join(groups, "rep", "left")
    usable = F.col("good") & F.col("vec_id").isNotNull()
    component = F.when(usable, F.coalesce("component", "rep")).otherwise(F.col("vec_id"))
    return placed.select(
        "vec_id",
        F.when(usable, F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
