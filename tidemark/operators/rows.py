"""Duplicates, unions, order and newest-of operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each identical row; combined on the map side, so a row repeated a
    billion times crosses the network once per task."""
    return df.dropDuplicates()


def one_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key: the one that is largest by ``newest_by``, then by its other columns.

    An aggregate, not a window: partial maxima are formed before the shuffle, so a hot
    key costs one row per task, and the choice does not depend on the row order.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [*newest_by, *(c for c in rest if c not in newest_by)]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(newest).select(*keys, "__row.*").select(*df.columns)


def union_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """United by column name; with ``allow_missing`` a column a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def ordered_by(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Sorted rows. Sort when reading: a table keeps no order between its files."""
    return df.orderBy(*columns)


def latest_file(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    """One row ``path, modified``: the most recently changed file below a folder.

    File contents are never read; ties go to the larger path.
    """
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, **options).load(folder)
    newest = F.max(F.struct("modificationTime", "path"))
    return files.agg(newest.alias("f")).select(
        F.col("f.path").alias("path"), F.col("f.modificationTime").alias("modified")
    )
