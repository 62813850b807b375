"""The ledger of landed folders: saved when landed, marked read when loaded.

It lies in one folder per queue and environment (``queue=…/env=…``), so a queue's readers open
only its own files. Runs append small files (deltas); ``fold_ledger`` turns them into a
snapshot. Entries are facts that may stand there twice, so neither a repeated append nor a fold
that breaks half-way changes an answer. Queue and environment must not be empty. A ledger
without such folders is carried over by ``append_entries(new, read_ledger(spark, old))``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import PATTERNS
from ..shared import filesystem

# Columns of the ledger.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("queue", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("readed", T.BooleanType()),
        T.StructField("env", T.StringType()),
        T.StructField("ts", T.StringType()),
    ]
)

#: A queue's ledger is folded when it has more small files than this.
FOLD_FILES = 32
#: Files of this size are left alone by folds.
FULL_BYTES = 64 * 1024 * 1024


def ledger_entries(ledger: DataFrame, queue: str, env: str) -> DataFrame:
    """Distinct ``(path, readed)`` of one queue and environment."""
    return ledger.where((F.col("queue") == queue) & (F.col("env") == env)).select("path", "readed").distinct()


def unread_paths(entries: DataFrame) -> DataFrame:
    """Saved paths never marked read; null and the text ``null`` are no paths.

    One aggregate per path with map-side combine does the work of the anti-join and
    of the duplicate removal.
    """
    paths = entries.where(F.col("path").isNotNull() & (F.col("path") != "null"))
    return paths.groupBy("path").agg(F.bool_or("readed").alias("done")).where("NOT done").select("path")


def entries_for(paths: DataFrame, queue: str, env: str, read: bool, at: datetime) -> DataFrame:
    """Ledger rows for a frame with a ``path`` column."""
    return paths.select(
        F.lit(queue).alias("queue"),
        F.col("path").cast("string").alias("path"),
        F.lit(read).alias("readed"),
        F.lit(env).alias("env"),
        F.lit(at.strftime("%Y-%m-%dT%H:%M")).alias("ts"),
    )


def append_entries(ledger_path: str, entries: DataFrame) -> None:
    """Append entries, for any queues.

    The files are written aside and then moved in. Jobs that append at the same time would
    otherwise clear each other's unfinished output.
    """
    spark = entries.sparkSession
    aside = f"{ledger_path.rstrip('/')}/_writing/{uuid.uuid4().hex}"
    fs, folder = filesystem(spark, aside)
    try:
        entries.write.partitionBy("queue", "env").parquet(aside)
        for written in (listed.getPath() for listed in _data_files(spark, aside)):
            target = written.getParent().toString().replace(folder.toString(), ledger_path.rstrip("/"), 1)
            fs.mkdirs(filesystem(spark, target)[1])
            if not fs.rename(written, filesystem(spark, target)[1]):
                raise OSError(f"{written.toString()} could not be moved to {target}")
    finally:
        fs.delete(folder, True)


def _data_files(spark: SparkSession, folder: str) -> list:
    """Listed data files below a folder; none where it is absent."""
    fs, path = filesystem(spark, folder)
    if not fs.exists(path):
        return []
    found, listing = [], fs.listFiles(path, True)
    while listing.hasNext():
        status = listing.next()
        if status.getPath().getName().endswith(".parquet"):
            found.append(status)
    return found


def fold_ledger(spark: SparkSession, ledger_path: str, queue: str, env: str, files: int = FOLD_FILES) -> int:
    """Make a snapshot of one queue's small files once there are more than ``files``; returns how many it replaced.

    The snapshot keeps each distinct ``(path, readed)`` with its last stamp. It is in place before
    exactly the files it was made from are deleted. Files of ``FULL_BYTES`` are never
    written again, so a fold costs what came since, and the number of files stays below ``files`` and one per
    ``FULL_BYTES``. A reader that listed the ledger before a fold may miss a file and has to read again.
    """
    # Spark makes the names of partition folders, so it is asked for them; it gives them as addresses
    book = read_ledger(spark, ledger_path).where((F.col("queue") == queue) & (F.col("env") == env))
    addresses = book.select(F.regexp_replace("_metadata.file_path", "/[^/]+$", "").alias("folder")).distinct().collect()
    uri, path_of = spark._jvm.java.net.URI, spark._jvm.org.apache.hadoop.fs.Path
    here = [path_of(uri(row.folder)).toString() for row in addresses]
    small = [s for folder in here for s in _data_files(spark, folder) if s.getLen() < FULL_BYTES]
    if len(small) <= files:
        return 0
    paths = [s.getPath() for s in small]
    facts = spark.read.schema(LEDGER_SCHEMA).option("basePath", ledger_path).parquet(*(p.toString() for p in paths))
    snapshot = facts.groupBy("queue", "env", "path", "readed").agg(F.max("ts").alias("ts"))
    parts = max(1, sum(s.getLen() for s in small) // (2 * FULL_BYTES))
    append_entries(ledger_path, snapshot.repartition(parts, "path"))
    fs, _ = filesystem(spark, ledger_path)
    for path in paths:
        fs.delete(path, False)
    return len(paths)


def append_paths(
    spark: SparkSession, ledger_path: str, queue: str, env: str, paths: Iterable[str], read: bool, at: datetime
) -> None:
    """Append one entry for each of a run's own folders."""
    rows = [(path,) for path in paths]
    if rows:
        frame = spark.createDataFrame(rows, "path string").coalesce(1)
        append_entries(ledger_path, entries_for(frame, queue, env, read, at))


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """All queues; a filter on queue and environment chooses folders, not rows."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def entry_times(ledger: DataFrame) -> DataFrame:
    """The ledger with its text stamp as a time."""
    return ledger.withColumn("at", F.try_to_timestamp("ts", F.lit(PATTERNS["iso_minute"])).cast("timestamp_ntz"))
