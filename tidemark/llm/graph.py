"""Intermediate tables in the shared folder, and connected components over Spark joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import filesystem, new_folder


@dataclass
class Stored:
    """A table written to the shared folder; it goes with the session unless dropped before."""

    df: DataFrame
    folder: str

    def drop(self) -> None:
        fs, path = filesystem(self.df.sparkSession, self.folder)
        fs.delete(path, True)


def store(df: DataFrame, label: str) -> Stored:
    """Cut the lineage: every executor can reach the written copy, whoever is lost."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    fs, path = filesystem(spark, folder)
    fs.deleteOnExit(path)
    return Stored(spark.read.schema(df.schema).parquet(folder), folder)


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every id in ``edges`` (a, b: long).

    Large-star and small-star in turn, each an aggregate of minima and a join with it, so a
    node with a third of all edges is summed up map-side and its join partition is split.
    Nulls and loops are ignored; without edges there are no rows.
    """
    lo, hi = F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
    now = store(edges.where("a <> b").select(lo, hi).distinct(), "edges")
    size = _fingerprint(now.df)
    while True:
        e = now.df
        both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where("lo > m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        then = store(small.union(low.select(F.col("m").alias("lo"), "hi")).distinct(), "edges")
        now.drop()
        now, before, size = then, size, _fingerprint(then.df)
        if size == before:
            break
    stars = now.df
    return stars.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(stars.select("lo", "lo").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    hashed = F.xxhash64("lo", "hi")
    return tuple(edges.agg(F.count("*"), F.sum(hashed.cast("decimal(20,0)")), F.bit_xor(hashed)).first())
