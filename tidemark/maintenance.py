"""Upkeep of published tables: merge small files, drop old versions, report."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import datetime, timedelta, timezone
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .folding import data_files, fold_batches, is_loaded, replaced_folders
from .shared import filesystem, holding, packed_scans, path_exists, settled
from .sinks.tables import (
    FIRST_LOCATION,
    FIRST_REPLACED,
    new_version,
    partition_columns,
    publish_version,
    quoted,
    set_table_note,
    table_location,
    table_note,
    version_root,
    version_time,
)
from .sources.catalog import SYSTEM_SCHEMAS, list_tables

log = logging.getLogger(__name__)

RETENTION_HOURS = 168
COMPACTED_FILES = "compacted_files"
FOLDS_EXPIRED = "folds_expired"
FILE_BYTES = 512 * 1024 * 1024
REPORT_SCHEMA = (
    "table string, status string, files_added bigint, files_removed bigint, "
    "bytes_removed bigint, files_expired bigint, message string"
)


def _size(spark: SparkSession, folder: str) -> tuple[int, int]:
    row = data_files(spark, folder).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    ).first()
    return row.files, row.bytes


def _usual_size(spark: SparkSession, folder: str) -> int:
    """Size of the file that a byte of the folder is in, on average: many tiny files beside large ones hardly count."""
    length = F.col("length").cast("double")
    return int(data_files(spark, folder).agg(F.sum(length * length) / F.sum(length)).first()[0] or 0)


def compact_table(spark: SparkSession, name: str, root: str, file_bytes: int = FILE_BYTES) -> tuple[int, int, int]:
    """Rewrite a table into files of about ``file_bytes``; returns files added, files
    removed and bytes made obsolete.

    Files of a plain table are shared out evenly by their bytes, and a task writes what it reads:
    about what makes up a file, give or take a row group, whatever its rows take when unpacked. Rows of a partitioned table
    are rebalanced by size, so a hot partition is shared between tasks. The old files stay
    until ``expire_versions``. Nothing is rewritten when there is already no more than
    one file per target size (or per partition), or no more than the last compaction left.
    In a table that loads write, only small settled batches are folded (``folding``).
    """
    if is_loaded(spark, name):
        return fold_batches(spark, name, file_bytes)
    location = table_location(spark, name)
    files, size = _size(spark, location)
    tasks = max(1, ceil(size / file_bytes))
    keys = partition_columns(spark, name)
    table = spark.table(quoted(name))
    wanted = max(tasks, spark.sql(f"SHOW PARTITIONS {quoted(name)}").count()) if keys else tasks
    if files <= max(wanted, int(table_note(spark, name, COMPACTED_FILES) or 0)):
        return 0, 0, 0
    target = new_version(root, name)
    if keys:
        # gathers each table partition, but splits a hot one and joins tiny ones by size
        table.hint("rebalance", *keys).write.partitionBy(*keys).parquet(target)
    else:
        usual = _usual_size(spark, location) if tasks > 1 else 0
        with holding(spark, **packed_scans(file_bytes, usual)):
            table.coalesce(tasks).write.parquet(target)
    publish_version(spark, name, table.schema, target, keys)
    added = _size(spark, target)[0]
    set_table_note(spark, name, COMPACTED_FILES, str(added))
    return added, files, size


def obsolete_versions(
    spark: SparkSession, name: str, root: str, hours: int = RETENTION_HOURS, as_of: datetime | None = None
) -> list[str]:
    """Folders of this table's versions that were replaced more than ``hours`` ago.

    A version is replaced when the next complete one is begun, however old it is itself;
    an abandoned write newer than all others counts by its own last change. The table's
    first location, which is no version folder, counts from its note, folders of folded
    batches from when they were folded. Other tables'
    versions and unknown folders are never listed.
    """
    limit = (as_of or datetime.now(timezone.utc)) - timedelta(hours=hours)
    first, replaced = table_note(spark, name, FIRST_LOCATION), table_note(spark, name, FIRST_REPLACED)
    gone = [first] if first and datetime.fromisoformat(replaced) < limit and path_exists(spark, first) else []
    done = table_note(spark, name, FOLDS_EXPIRED)
    gone += replaced_folders(spark, name, limit, datetime.fromisoformat(done) if done else None)
    if not path_exists(spark, root):
        return gone
    fs, jroot = filesystem(spark, root)
    current = table_location(spark, name).rstrip("/").rsplit("/", 1)[-1]
    folders = {s.getPath().getName(): s for s in fs.listStatus(jroot) if version_time(s.getPath().getName(), name)}
    complete = [n for n, s in folders.items() if path_exists(spark, f"{s.getPath().toString()}/_SUCCESS")]
    old = gone
    for named, status in folders.items():
        began = version_time(named, name)
        later = [version_time(n, name) for n in complete if version_time(n, name) > began]
        changed = datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)
        if named != current and (min(later) if later else changed) < limit:
            old.append(status.getPath().toString())
    return sorted(old)


def expire_versions(
    spark: SparkSession,
    name: str,
    root: str,
    hours: int = RETENTION_HOURS,
    as_of: datetime | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Files of obsolete versions (``path, length``); deletes their folders unless dry.

    The listing is written out before the delete, so it can still be read afterwards.
    """
    folders = obsolete_versions(spark, name, root, hours, as_of)
    if not folders:
        return spark.createDataFrame([], "path string, length bigint")
    listing = settled(spark, data_files(spark, folders).select("path", "length"), "expired")
    if not dry_run:
        for folder in folders:
            fs, jpath = filesystem(spark, folder)
            fs.delete(jpath, True)
        if is_loaded(spark, name):  # folds before this time need not be looked at again
            limit = (as_of or datetime.now(timezone.utc)) - timedelta(hours=hours)
            set_table_note(spark, name, FOLDS_EXPIRED, limit.isoformat())
    return listing


def maintain(
    spark: SparkSession,
    roots: dict[str, str] | None = None,
    catalogs: Iterable[str] = ("spark_catalog",),
    excluded: Iterable[str] = SYSTEM_SCHEMAS,
    hours: int = RETENTION_HOURS,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Compact and expire every table of the catalogs; one report row per table.

    A failing table is reported and the others go on.
    """
    report = []
    for catalog in catalogs:
        for row in list_tables(spark, catalog, excluded).collect():
            name = f"{row.table_schema}.{row.table_name}"
            whole = f"{catalog}.{name}"  # a namesake in another catalog is another table
            try:
                root = (roots or {}).get(whole) or (roots or {}).get(name) or version_root(spark, whole)
                added, removed, size = compact_table(spark, whole, root, file_bytes)
                expired = expire_versions(spark, whole, root, hours).count()
                report.append((name, "ok", added, removed, size, expired, None))
            except Exception as error:  # noqa: BLE001 - one bad table must not stop the rest
                log.error("skipping %s: %s", name, error)
                report.append((name, "failed", None, None, None, None, str(error)[:500]))
    return spark.createDataFrame(report, REPORT_SCHEMA)
