"""Sharding by k-d tree partitioning: shards of equal bytes, each a box of the metadata.

The tree starts with all rows and the number of shards they are to fill. A node of several shards
is cut along its widest dimension, at the weighted median (the quantile that its halves' shares of
shards ask for), until every leaf is one shard of the target bytes. Dimensions are metadata:
numbers scaled to their range over the table, texts placed by hash, so rows of one source lie at
one point. Rows at one point go by a hash of their text, then of their id, so a point may be cut,
and copies of a text stay together unless a cut goes through them: a source or a group of copies
with a third of all rows fills as many shards as it has bytes for.

Medians are found by refined histograms: one map-side aggregate gives the bytes of up to
``BINS`` slices of each node's range, the slice with the median is sliced again, until it weighs
less than ``TOLERANCE`` of a shard or is a single row. All nodes of a level are cut at once. Rows
are never sorted or gathered; boxes, cuts and histograms are tables, however many shards there are.
Slots are numbered within hashed parts of a shard and offset by the parts' counts.

Defined results: a null text has no bytes, so its row weighs 1 like that of an empty one; null
metadata lies at the low end of its dimension; repeated rows and rows without id are placed like
others; one row heavier than a shard makes a shard heavier; an empty table gives no rows. Columns
are carried on request and keep their names; ones named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import Stored, store

BINS = 1 << 15
TOLERANCE = 1 / 1024
PART_ROWS = 1 << 16
COORDINATE_BITS = 20
TEXT_BITS = 43

_CELLS = (1 << COORDINATE_BITS) - 1
_TOP = (1 << 63) - 1
_LOW = (1 << 20) - 1


def text_bytes(text: str = "text") -> Column:
    """What a row weighs: the UTF-8 bytes of its text and one more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _coordinates(docs: DataFrame, dimensions: Mapping[str, Column]) -> tuple[list[Column], dict]:
    """Each dimension as a whole number of ``COORDINATE_BITS`` bits; and the number of rows and bytes."""
    kinds = {f.name: f.dataType for f in docs.select(*(c.alias(n) for n, c in dimensions.items())).schema}
    texts = {n for n, t in kinds.items() if not isinstance(t, T.NumericType)}
    numbers = {n: c.cast("double") for n, c in dimensions.items() if n not in texts}
    numbers = {n: F.when(F.abs(c) < F.lit(float("inf")), c) for n, c in numbers.items()}
    facts = docs.agg(
        F.count("*").alias("__rows"), F.coalesce(F.sum(text_bytes()), F.lit(0)).alias("__bytes"),
        *(f(c).alias(f"{f.__name__} {n}") for n, c in numbers.items() for f in (F.min, F.max)),
    ).first().asDict()
    out = []
    for name, column in dimensions.items():
        if name in texts:
            place = F.shiftrightunsigned(F.xxhash64(column.cast("string")), 64 - COORDINATE_BITS)
        else:
            low, high = facts[f"min {name}"], facts[f"max {name}"]
            flat = low is None or low == high
            place = F.lit(0) if flat else F.floor((numbers[name] - low) / (high - low) * _CELLS)
        out.append(F.when(column.isNotNull(), F.coalesce(place, F.lit(0))).otherwise(0).cast("long").alias(f"__c{len(out)}"))
    return out, facts


def assign_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Mapping[str, Column] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs`` (doc_id, text), and the columns to ``carry``.

    Give the number of shards or the bytes one should have. ``dimensions`` are numbers or texts by
    name; by default source, language, length (its logarithm) and id, as far as the table has them.
    """
    if dimensions is None:
        known = {"source": F.col("source"), "lang": F.col("lang"), "n_chars": F.log2(1 + F.greatest(F.col("n_chars"), F.lit(0))), "doc_id": F.col("doc_id")}
        dimensions = {n: c for n, c in known.items() if n in docs.columns}
    coordinates, facts = _coordinates(docs, dimensions)
    if shards is None:
        shards = max(1, -(-facts["__bytes"] // target_bytes))
    results = ("doc_id", "size", "text_crc32", "shard", "slot")
    kept = [c for c in carry if c not in results]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64("text"), 64 - TEXT_BITS).alias("__text"),
        F.monotonically_increasing_id().alias("__row"), *coordinates, *kept,
    )
    # by id, and only rows of one id by where they stand
    own = F.shiftrightunsigned(F.xxhash64("doc_id"), 1).bitwiseAND(F.lit(_TOP - _LOW)).bitwiseOR(F.xxhash64("__row").bitwiseAND(F.lit(_LOW)))
    tree = store(
        rows.withColumn("__k1", own).withColumn("__node", F.lit(0).cast("long")).withColumn("__share", F.lit(shards).cast("long")), "shards"
    )
    widest = shards
    while widest > 1:
        cuts = _cuts(tree.df, len(coordinates), facts["__bytes"] / shards * TOLERANCE)
        after = store(_divided(tree.df, cuts.df), "shards")
        tree.drop()
        cuts.drop()
        tree, widest = after, -(-widest // 2)
    return _numbered(tree.df, facts["__rows"], shards).select(*results, *(c for c in kept))


def _k0(dimension: Column, n: int) -> Column:
    """Place of a row along a dimension of its node: the coordinate, then the text's hash."""
    place = F.element_at(F.array(*(F.col(f"__c{i}") for i in range(n))), (dimension + 1).cast("int"))
    return F.shiftleft(place, TEXT_BITS).bitwiseOR(F.col("__text"))


def _cuts(rows: DataFrame, n: int, tolerance: float) -> Stored:
    """Where each node that is no leaf is cut: rows up to ``(c0, c1)`` along ``dimension`` go to the left."""
    widths = F.array(*(F.max(f"__c{i}") - F.min(f"__c{i}") for i in range(n)))
    boxes = rows.where("__share > 1").groupBy(F.col("__node").alias("node"), F.col("__share").alias("share")).agg(
        F.sum("size").alias("bytes"), (F.array_position(widths, F.array_max(widths)) - 1).alias("dimension")
    )
    left = F.expr("share div 2")
    state = boxes.select(
        "node", "dimension", left.alias("left"), F.floor(F.col("bytes") * (left / F.col("share"))).alias("aim"),
        F.lit(False).alias("within"), F.lit(0).cast("long").alias("point"), F.lit(0).cast("long").alias("lo"), F.lit(_TOP).alias("hi"),
        F.lit(0).cast("long").alias("below"), F.lit(False).alias("found"), F.lit(0).cast("long").alias("c0"), F.lit(0).cast("long").alias("c1"),
    )
    held = store(state, "cuts")
    while not held.df.where("NOT found").isEmpty():
        after = store(_refined(rows, held.df, n, tolerance), "cuts")
        held.drop()
        held = after
    return held


def _refined(rows: DataFrame, state: DataFrame, n: int, tolerance: float) -> DataFrame:
    """One histogram for each node whose cut is open; the slice that holds its median becomes the range."""
    seen = rows.select("__node", "size", "__k1", "__text", *(f"__c{i}" for i in range(n)))
    open_rows = seen.join(state.where("NOT found"), F.col("__node") == F.col("node")).withColumn("k0", _k0(F.col("dimension"), n))
    value = F.when(F.col("within"), F.col("__k1")).otherwise(F.col("k0"))
    inside = open_rows.withColumn("v", value).where("(NOT within OR k0 = point) AND v BETWEEN lo AND hi")
    slices = inside.withColumn("slice", F.expr(f"(v - lo) div ((hi - lo) div {BINS} + 1)")).groupBy("node", "slice").agg(
        F.sum("size").alias("weight"), F.min("v").alias("v_lo"), F.max("v").alias("v_hi")
    )
    so_far = Window.partitionBy("node").orderBy("slice")
    summed = slices.withColumn("upto", F.sum("weight").over(so_far)).join(state.select("node", "aim", F.col("below").alias("base")), "node")
    chosen = summed.where("base + upto >= aim").groupBy("node").agg(F.min_by(F.struct("weight", "v_lo", "v_hi", (F.col("base") + F.col("upto") - F.col("weight")).alias("under")), "slice").alias("s"))
    now = state.join(chosen, "node", "left")
    light, single = F.col("s.weight") <= tolerance, F.col("s.v_lo") == F.col("s.v_hi")
    ends = light | (single & F.col("within"))
    into = single & ~light & ~F.col("within")  # a point too heavy to go to one side: cut by id
    takes = F.col("aim") - F.col("s.under") > F.col("s.weight") / 2  # the slice goes to the side it fits better
    c0 = F.when(F.col("within"), F.col("point")).when(takes, F.col("s.v_hi")).otherwise(F.col("s.v_lo"))
    c1 = F.when(F.col("within"), F.when(takes, F.col("s.v_hi")).otherwise(F.col("s.v_lo") - 1)).otherwise(F.when(takes, F.lit(_TOP)).otherwise(F.lit(-1)))
    open_now = ~F.col("found")
    return now.select(
        "node", "dimension", "left", "aim",
        F.when(open_now & into, True).otherwise(F.col("within")).alias("within"),
        F.when(open_now & into, F.col("s.v_lo")).otherwise(F.col("point")).alias("point"),
        F.when(open_now & into, F.lit(0)).when(open_now, F.col("s.v_lo")).otherwise(F.col("lo")).alias("lo"),
        F.when(open_now & into, F.lit(_TOP)).when(open_now, F.col("s.v_hi")).otherwise(F.col("hi")).alias("hi"),
        F.when(open_now, F.col("s.under")).otherwise(F.col("below")).alias("below"),
        (F.col("found") | ends).alias("found"),
        F.when(open_now & ends, c0).otherwise(F.col("c0")).alias("c0"), F.when(open_now & ends, c1).otherwise(F.col("c1")).alias("c1"),
    )


def _divided(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows with the node below the one they were in, and how many shards it fills."""
    n = sum(1 for c in rows.columns if c.startswith("__c"))
    k0 = _k0(F.col("dimension"), n)
    stays = (k0 < F.col("c0")) | ((k0 == F.col("c0")) & (F.col("__k1") <= F.col("c1")))
    cut = F.col("node").isNotNull()
    joined = rows.join(cuts.select("node", "dimension", "left", "c0", "c1"), F.col("__node") == F.col("node"), "left")
    node = F.when(cut & ~stays, F.col("__node") + F.col("left")).otherwise(F.col("__node"))
    share = F.when(cut & stays, F.col("left")).when(cut, F.col("__share") - F.col("left")).otherwise(F.col("__share"))
    return joined.select(*(c for c in rows.columns if c not in ("__node", "__share")), node.alias("__node"), share.alias("__share"))


def _numbered(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """Leaves as shards, and a slot for each row: its place in a hashed part of the shard, after the parts before."""
    parts = max(1, -(-n // (shards * PART_ROWS)))
    placed = rows.withColumn("shard", F.col("__node").cast("int")).withColumn("__part", F.pmod(F.xxhash64("__k1"), F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "__part").agg(F.count("*").alias("__n"))
    offsets = counts.select("shard", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = Window.partitionBy("shard", "__part").orderBy("doc_id", "__text", "__row")
    return placed.join(offsets, ["shard", "__part"]).withColumn("slot", F.col("__before") + F.row_number().over(own) - 1)


def write_shards(docs: DataFrame, folder: str, **options) -> None:
    """The rows of ``docs`` in one folder a shard (``shard=0``, ...), in files of ``PART_ROWS`` slots, each in order."""
    found = assign_shards(docs, carry=docs.columns, **options)
    found.repartition("shard", F.expr(f"slot div {PART_ROWS}")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
