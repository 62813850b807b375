"""The folder every node of the cluster can reach, and the file system behind it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
PIECES = 16  # pieces of a scan that make up a file to be written
CUTS = 8  # pieces a file is cut into at least, where it is cut, or files that make up a piece


def shared_folder(spark: SparkSession) -> str:
    """The cluster's own checkpoint folder; a fresh local one only where none is named and Spark is local.

    On a cluster a local folder would be another one on every node, so there it must be named.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all nodes share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody else uses; it is not created."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system and path object, for metadata calls (list, rename, delete)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = filesystem(spark, path)
    return fs.exists(jpath)


def settled(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a result once and read it back, so that later passes see one snapshot.

    A database or an unversioned folder read twice may answer differently each
    time; the written copy also survives the loss of executors. It goes with the session.
    """
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    fs, path = filesystem(spark, folder)
    fs.deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)


def pinned_session(spark: SparkSession, **conf: object) -> SparkSession:
    """A session like this one whose settings later changes, and the number of executors, do not reach."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **conf}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, str(value))
    return own


@contextmanager
def holding(spark: SparkSession, **conf: object) -> Iterator[None]:
    """Settings of this very session for the length of a block: it alone may know a catalog that was named later."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def packed_scans(file_bytes: int, usual: int = 0) -> dict[str, int]:
    """Settings that share files out to tasks by their bytes alone, in pieces so small that a few make up ``file_bytes``.

    The default counts 4 MB for each file; with ``coalesce`` the large ones would then come to one task.
    A row group is read with the piece that holds its middle, and what is left of each file is listed after
    all whole pieces. So a file of ``usual`` bytes, where several tasks share them, is cut into many pieces
    or not at all: in two, the first tasks would read all halves that hold a middle and the last ones none.
    """
    piece = file_bytes // PIECES
    if usual > piece // CUTS:
        piece = min(piece, usual // CUTS)
    return {
        "spark.sql.files.maxPartitionBytes": max(1, piece),
        "spark.sql.files.openCostInBytes": 1,
        "spark.sql.files.minPartitionNum": 1,  # pieces do not depend on the number of cores
    }


@contextmanager
def settled_batch(spark: SparkSession, df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A settled result for the length of a block; its copy is deleted afterwards."""
    folder = new_folder(spark, label)
    try:
        df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        fs, jpath = filesystem(spark, folder)
        fs.delete(jpath, True)
