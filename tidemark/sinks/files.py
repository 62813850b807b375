"""Landing files."""

from __future__ import annotations

from datetime import datetime
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("json", "csv", "parquet")
FLUSH_ROWS = 100_000
NO_MARK_COLUMN = "-"


class WriteMode(str, Enum):
    APPEND = "append"
    OVERWRITE = "overwrite"

    @classmethod
    def for_mark_column(cls, column: str | None) -> WriteMode:
        """A table without a mark column (``-``) is loaded whole, so it replaces."""
        return cls.OVERWRITE if column in (None, "", NO_MARK_COLUMN) else cls.APPEND

    @classmethod
    def of(cls, value: str | WriteMode | list[str]) -> WriteMode:
        """A configured mode; old configurations hold it in a list of one."""
        if isinstance(value, list):
            (value,) = value
        return cls(value)


def write_files(
    df: DataFrame,
    path: str,
    file_format: str = "json",
    mode: str | WriteMode = WriteMode.APPEND,
    files: int | None = None,
    max_records: int | None = None,
) -> None:
    """Write landing files.

    Null fields stay in JSON, so an all-null column survives. The number of files is
    Spark's choice unless ``files`` asks for one; it makes that many write tasks, so
    keep it for small extracts. ``max_records`` starts a new file after that many rows.
    """
    if file_format not in FORMATS:
        raise ValueError(f"landing format must be one of {FORMATS}, not {file_format!r}")
    writer = (df.repartition(files) if files else df).write.mode(WriteMode.of(mode).value)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if file_format == "json":
        writer = writer.option("ignoreNullFields", False)
    if file_format == "csv":
        # doubled quotes and kept blanks, so that readers get the very text back
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.format(file_format).save(path)


def write_unless_empty(df: DataFrame, path: str, **options: object) -> bool:
    """Write and return True, or leave the folder alone when there are no rows.

    Looks at one row, not at a full count.
    """
    if df.isEmpty():
        return False
    write_files(df, path, **options)
    return True


def run_folder(path: str, at: datetime) -> str:
    """A run's own landing folder, stamped to the minute; Spark's part names keep two
    writes in one minute apart."""
    return f"{path.rstrip('/')}/run={at.strftime('%Y-%m-%dT%H-%M')}"


def with_run(df: DataFrame, at: datetime) -> DataFrame:
    return df.withColumn("run", F.lit(at.strftime("%Y-%m-%dT%H-%M")))
