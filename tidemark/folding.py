"""Folding the small partitions of loaded tables into coarse ones.

A load makes a partition of each micro-batch, so a table fed often has many small files. Folding
bin-packs settled partitions by size and writes each bin as one partition; only what is small is
read and written. A batch is settled when a later one of its stream is there: only the last may be
replayed. What was folded is listed in a table beside the versions (``fold, label, folder, at``),
so that a load that meets a folded label again knows that its rows are in already.

The listing is written after the new files and before the catalog changes, so a run that breaks
off is finished by the next load or compaction. Readers of the old partitions keep their files
until ``maintenance.expire_versions`` takes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import holding, packed_scans, path_exists
from .sinks.tables import (
    LOAD_BATCH,
    VERSION_STAMP,
    add_partitions,
    drop_partitions,
    partition_columns,
    quoted,
    table_location,
    version_root,
)

FOLD_PARTITIONS = 2_000  # partitions folded in one write; their names pass the driver
FOLDS_AT_ONCE = 100  # bins in one job, each a scan of its own
FOLD_PREFIX = "fold-"
# Each task of a union writes one partition, so no sort has to bring its rows together; and the
# tasks of its parts, one each, must not become one.
UNSORTED_UNION = {"spark.sql.maxConcurrentOutputFileWriters": 2, "spark.sql.unionOutputPartitioning": "false"}
FOLDS_SCHEMA = "fold string, label string, folder string, files bigint, bytes bigint, at timestamp"


@dataclass(frozen=True)
class Small:
    """A partition that may be folded."""

    label: str
    files: int
    size: int


def data_files(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """Parquet files below a folder: ``path, length, modificationTime`` (contents not read)."""
    return (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="*.parquet")
        .load(folder)
        .select("path", "length", "modificationTime")
    )


def is_loaded(spark: SparkSession, name: str) -> bool:
    """Whether loads write the table: its partitions are micro-batches."""
    return partition_columns(spark, name) == [LOAD_BATCH]


def folds_folder(spark: SparkSession, name: str) -> str:
    """Where a table's folds are listed: beside its versions, whatever its location is by now."""
    return f"{version_root(spark, name)}/folds-{name.replace('`', '').split('.')[-1]}"


def read_folds(spark: SparkSession, name: str) -> DataFrame:
    folder = folds_folder(spark, name)
    return spark.read.schema(FOLDS_SCHEMA).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], FOLDS_SCHEMA)


def _partitions(spark: SparkSession, name: str) -> DataFrame:
    """Labels the table has now, with the stream and the number of those that are no folds."""
    label = F.split_part("partition", F.lit("="), F.lit(2))
    parts = F.regexp_extract("label", r"^(.*)-(\d+)$", 1), F.regexp_extract("label", r"^(.*)-(\d+)$", 2)
    named = spark.sql(f"SHOW PARTITIONS {quoted(name)}").select(label.alias("label"))
    return named.select("label", parts[0].alias("stream"), F.nullif(parts[1], F.lit("")).cast("long").alias("number"))


def partition_files(spark: SparkSession, name: str) -> DataFrame:
    """``label, files, size, last`` of the partitions the table has now; ``last``: of its stream, so it may be replayed."""
    now = _partitions(spark, name)
    newest = now.where(~F.startswith("label", F.lit(FOLD_PREFIX))).groupBy("stream").agg(F.max("number").alias("newest"))
    label = F.regexp_extract("path", f"/{LOAD_BATCH}=([^/]+)/[^/]+$", 1)
    sizes = data_files(spark, table_location(spark, name)).groupBy(label.alias("label")).agg(F.count("*").alias("files"), F.sum("length").alias("size"))
    settled = F.startswith("label", F.lit(FOLD_PREFIX)) | (F.col("number") < F.col("newest"))
    return now.join(newest, "stream", "left").join(sizes, "label", "left").select(
        "label", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("size", F.lit(0)).alias("size"), (~F.coalesce(settled, F.lit(False))).alias("last")
    )


def plan_folds(partitions: Sequence[Small], file_bytes: int) -> list[list[Small]]:
    """Bins of neighbours of about ``file_bytes`` each; a bin that would change nothing is left out."""
    bins: list[list[Small]] = []
    held = 0
    for p in sorted(partitions, key=lambda p: p.label):
        if not bins or held + p.size > file_bytes:
            bins.append([])
            held = 0
        bins[-1].append(p)
        held += p.size
    return [b for b in bins if sum(p.files for p in b) > _files_for(b, file_bytes) or len(b) > 1]


def _files_for(members: Sequence[Small], file_bytes: int) -> int:
    return max(1, -(-sum(p.size for p in members) // file_bytes))


def fold_batches(spark: SparkSession, name: str, file_bytes: int) -> tuple[int, int, int]:
    """Fold what is small and settled; returns files added, files replaced and their bytes."""
    finish_folds(spark, name)
    added = removed = size = 0
    while True:
        small = (F.col("size") < file_bytes / 2) | (F.col("files") > 2 * F.ceil(F.col("size") / file_bytes))
        found = partition_files(spark, name).where(~F.col("last") & small).orderBy("label").limit(FOLD_PARTITIONS).collect()
        bins = plan_folds([Small(r.label, r.files, r.size) for r in found], file_bytes)
        if not bins:
            return added, removed, size
        added += _fold(spark, name, bins, file_bytes)
        removed += sum(p.files for b in bins for p in b)
        size += sum(p.size for b in bins for p in b)


def _fold(spark: SparkSession, name: str, bins: list[list[Small]], file_bytes: int) -> int:
    """Write each bin as a partition, list it, and put it in the place of its members; returns the number of files."""
    location, now = table_location(spark, name).rstrip("/"), datetime.now(timezone.utc)
    stamp = f"{FOLD_PREFIX}{now.strftime(VERSION_STAMP)}-{uuid.uuid4().hex[:8]}"
    folds = [f"{stamp}-{i:05d}" for i in range(len(bins))]
    rows = [(fold, p.label, f"{location}/{LOAD_BATCH}={p.label}", p.files, p.size, now) for fold, members in zip(folds, bins) for p in members]
    listed = spark.createDataFrame(rows, FOLDS_SCHEMA).coalesce(1)
    _write_bins(spark, name, location, list(zip(folds, bins)), file_bytes)
    listed.write.mode("append").parquet(folds_folder(spark, name))
    _swap(spark, name, folds, [p.label for b in bins for p in b])
    written = data_files(spark, [f"{location}/{LOAD_BATCH}={f}" for f in folds if path_exists(spark, f"{location}/{LOAD_BATCH}={f}")])
    return written.count()


def _write_bins(spark: SparkSession, name: str, location: str, bins: list[tuple[str, list[Small]]], file_bytes: int) -> None:
    """Write each bin under its fold's name: a task reads what makes up one file and writes it as it comes.

    Rows are neither dealt out nor sorted, since even a small file may hold many long ones: a path
    that all rows share is stored once.
    """
    table = spark.table(quoted(name))
    columns = [F.col(f"`{c}`") for c in table.columns if c != LOAD_BATCH]

    def one(fold: str, members: list[Small]) -> DataFrame:
        rows = table.where(F.col(LOAD_BATCH).isin([p.label for p in members]))
        return rows.select(*columns, F.lit(fold).alias(LOAD_BATCH)).coalesce(_files_for(members, file_bytes))

    shared = [p for _, members in bins if _files_for(members, file_bytes) > 1 for p in members]
    usual = sum(p.size * p.size // max(1, p.files) for p in shared) // sum(p.size for p in shared) if shared else 0
    with holding(spark, **packed_scans(file_bytes, usual), **UNSORTED_UNION):
        for i in range(0, len(bins), FOLDS_AT_ONCE):
            rows = reduce(DataFrame.union, (one(*b) for b in bins[i : i + FOLDS_AT_ONCE]))
            rows.write.mode("append").partitionBy(LOAD_BATCH).parquet(location)


def _swap(spark: SparkSession, name: str, folds: Sequence[str], labels: Sequence[str]) -> None:
    drop_partitions(spark, name, [f"{LOAD_BATCH}={label}" for label in labels])
    add_partitions(spark, name, [f"{LOAD_BATCH}={fold}" for fold in folds])
    spark.catalog.refreshTable(quoted(name))


def finish_folds(spark: SparkSession, name: str) -> None:
    """Put folds in place that are listed but whose members are still in the table: a run broke off there."""
    if not spark.catalog.tableExists(quoted(name)) or not is_loaded(spark, name) or not path_exists(spark, folds_folder(spark, name)):
        return
    now = _partitions(spark, name).select("label")
    listed = read_folds(spark, name).select("fold", "label")
    folded_on = listed.select(F.col("label").alias("fold")).distinct()  # folds that were folded again
    open_folds = listed.join(folded_on, "fold", "left_anti").select("fold").distinct().join(now.select(F.col("label").alias("fold")), "fold", "left_anti")
    members = listed.join(now, "label", "left_semi")
    folds = [r.fold for r in open_folds.union(members.select("fold")).distinct().collect()]
    if folds:
        current = [r.fold for r in listed.where(F.col("fold").isin(folds)).join(folded_on, "fold", "left_anti").select("fold").distinct().collect()]
        _swap(spark, name, current, [r.label for r in members.select("label").distinct().collect()])


def not_folded(spark: SparkSession, name: str, labels: DataFrame, column: str) -> DataFrame:
    """Rows whose label is not in a fold of the table: the rows of a folded one are in the table already."""
    if not spark.catalog.tableExists(quoted(name)):
        return labels
    return labels.join(read_folds(spark, name).select(F.col("label").alias(column)).distinct(), column, "left_anti")


def replaced_folders(spark: SparkSession, name: str, before: datetime, after: datetime | None = None) -> list[str]:
    """Folders of partitions folded before a time (and after another) that are still there."""
    if not is_loaded(spark, name):
        return []
    rows = read_folds(spark, name).where(F.col("at") < F.lit(before))
    if after:
        rows = rows.where(F.col("at") >= F.lit(after))
    return sorted(r.folder for r in rows.select("folder").distinct().collect() if path_exists(spark, r.folder))
