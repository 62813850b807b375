"""Conflict-constrained best-fit packing of documents into bins.

A bin holds at most ``capacity`` units and never two pieces of one source or of one cluster
of duplicates. A text longer than a bin is cut into full pieces, each a bin of its own, and
a rest that is packed like any other text. Rests are dealt by hash into shards of about
``SHARD_ROWS``, each packed by one task: largest first, into the open bin with the least
residual that holds it. Bins are ordered by residual and carry their sources and clusters
as bitmaps; from the tightest bin on, successors are tried until one is compatible.

The number of bins lost by sharding is under one part in some hundreds (the open bins of a
shard), and no shard grows with the data: one of more than ``HOT_SHARD`` rows, which only equal
rows can make, is cut again.

Defined results: null and empty texts are one piece of no units, packed like others; a null
source or cluster conflicts with nothing; equal sizes go by id, then by what else the row
holds; repeated rows are pieces of their own; an empty table gives no rows.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 8192
SHARD_ROWS = 2048
HOT_SHARD = 4 * SHARD_ROWS  # rows of a shard from which on it is cut

_PACKED = "doc_id long, piece long, start long, size long, bin_id long, bin_offset long"


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item, in the order given. None as source or cluster never conflicts."""
    bits: dict[tuple[str, object], int] = {}
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    held: list[int] = []  # each bin's bitmap
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters):
        mine = 0
        for name in (("source", source), ("cluster", cluster)):
            if name[1] is not None:
                mine |= 1 << bits.setdefault(name, len(bits))
        at = bisect.bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and held[open_bins[at][1]] & mine:
            at += 1
        if at < len(open_bins):
            residual, number = open_bins.pop(at)
        else:
            residual, number = capacity, len(held)
            held.append(0)
        placed.append((number, capacity - residual))
        held[number] |= mine
        bisect.insort(open_bins, (residual - size, number))
    return placed


def pack(docs: DataFrame, capacity: int = CAPACITY, size: Column | None = None, cluster: Column | None = None) -> DataFrame:
    """Where each piece of ``docs`` (doc_id, text, source) goes: ``doc_id, piece, start, size, bin_id, bin_offset``.

    ``size`` is a text's length in units (code points), ``cluster`` what duplicates share
    (a hash of the text). ``start`` counts units from the beginning of the text.
    """
    size = F.length("text") if size is None else size
    cluster = F.xxhash64("text") if cluster is None else cluster
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("units"), F.when(F.col("text").isNotNull(), cluster).alias("cluster"),
    )
    whole = (F.col("units") / capacity).cast("long")
    full = rows.where(F.col("units") >= capacity).select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)).alias("piece"))
    # full pieces fill a bin each; theirs are the negative numbers
    alone = full.select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("start"), F.lit(capacity).cast("long").alias("size"),
        (-1 - F.monotonically_increasing_id()).alias("bin_id"), F.lit(0).cast("long").alias("bin_offset"),
    )
    rests = rows.where((F.col("units") % capacity > 0) | (F.col("units") == 0)).select(
        "doc_id", whole.alias("piece"), (F.col("units") % capacity).alias("size"), "source", "cluster"
    )
    shards = max(1, -(-docs.count() // SHARD_ROWS))
    named = rests.withColumn("shard", F.pmod(F.xxhash64("doc_id", "size", "source", "cluster", F.lit(17)), F.lit(shards)))
    # equal rows have one hash: a shard that they make large is cut further, by where its rows stand
    cuts = named.groupBy("shard").count().where(F.col("count") > HOT_SHARD).select("shard", F.ceil(F.col("count") / SHARD_ROWS).alias("_parts"))
    part = F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_parts")), F.lit(0))
    dealt = named.withColumn("_row", F.monotonically_increasing_id()).join(cuts, "shard", "left").withColumn("shard", F.col("shard") + shards * part)

    def fill(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "doc_id", "piece", "source", "cluster"], ascending=[False, True, True, True, True], kind="stable")
        names = [[None if pd.isna(v) else v for v in frame[c]] for c in ("source", "cluster")]
        placed = best_fit(frame["size"].tolist(), *names, capacity)
        out = frame[["doc_id", "piece"]].copy()
        out["start"] = frame["piece"] * capacity
        out["size"] = frame["size"]
        out["bin_id"] = [key[0] * (1 << 32) + number for number, _ in placed]
        out["bin_offset"] = [offset for _, offset in placed]
        return out

    # a missing id or cluster must stay a whole number in pandas, so both travel as text
    texts = dealt.select("shard", F.col("doc_id").cast("string").alias("doc_id"), "piece", "size", "source", F.col("cluster").cast("string").alias("cluster"))
    packed = texts.groupBy("shard").applyInPandas(fill, _PACKED.replace("doc_id long", "doc_id string"))
    return alone.unionByName(packed.withColumn("doc_id", F.col("doc_id").cast("long")))
