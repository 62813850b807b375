"""Source files for the queries, written by Spark from the given tables.

Reusable inputs are staged once per session and table folder, below the cluster's
shared folder. Everything a query itself has to write goes to a fresh folder per call.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import filesystem, new_folder

_STAGED: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, sf_dir: str, label: str, build: Callable[[str], None]) -> str:
    """Folder of a staged input, built on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _STAGED:
        folder = new_folder(spark, label)
        build(folder)
        _STAGED[key] = folder
    return _STAGED[key]


def fresh_schema() -> str:
    """A catalog schema of this call's own."""
    return f"tidemark_{uuid.uuid4().hex[:12]}"


def write_lines(df: DataFrame, line: Column, header: str, folder: str, mode: str = "errorifexists") -> None:
    """Raw text lines, with a header line at the head of every file."""
    row_in_file = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    first = row_in_file == 0
    df.select(F.when(first, F.concat(F.lit(header + "\n"), line)).otherwise(line).alias("value")).write.mode(
        mode
    ).text(folder)


def write_named(df: DataFrame, stem: str, folder: str, file_format: str = "csv", **options) -> None:
    """Add files to a folder whose names begin with ``stem``; Spark adds part number and id."""
    named = {"mapreduce.output.basename": stem, **options}
    df.write.mode("append").format(file_format).options(**named).save(folder)


def write_archives(df: DataFrame, folder: str, stem: str, members: dict[str, str]) -> None:
    """ZIP archives of naive CSV members, one archive per Arrow batch of rows.

    ``members`` maps a member name to the boolean column that picks its rows. Archive
    names depend on partition and batch only, so a repeated task writes the same files.
    """
    fs, jfolder = filesystem(df.sparkSession, folder)
    fs.mkdirs(jfolder)
    target = fs.makeQualified(jfolder).toString()
    flags = list(members.values())
    data = [c for c in df.columns if c not in flags]

    def pack(batches):
        store, root = pa.fs.FileSystem.from_uri(target.replace("file:/", "file:///", 1) if "://" not in target else target)
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            rows = pa.Table.from_batches([batch])
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                for member, flag in members.items():
                    text = io.BytesIO()
                    options = pa.csv.WriteOptions(quoting_style="none", quoting_header="none")
                    pa.csv.write_csv(rows.filter(rows[flag]).select(data), text, options)
                    archive.writestr(member, text.getvalue())
            with store.open_output_stream(f"{root}/{stem}_{part:05d}-{number:05d}.zip") as out:
                out.write(packed.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    df.mapInArrow(pack, "n bigint").agg(F.sum("n")).collect()
