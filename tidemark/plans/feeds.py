"""One extract function per kind of source, from mark or window to shaped rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ConfigError, LandingJob, TableSpec, render_path
from ..functions.audit import extraction_literals
from ..functions.payload import stringify_all
from ..functions.text import iso_prefix
from ..operators.filters import in_range, newer_than, on_days, text_time_between
from ..operators.joins import in_windows_union
from ..operators.rows import distinct_rows
from ..operators.windows import WindowRule, days_since, window_for, yesterday
from ..sources.archives import zipped_csv
from ..sources.databases import Connection, Slices, incremental_condition, read_filtered, slice_range
from ..sources.documents import field_names, plain_documents, require_documents, typed_documents
from ..sources.files import (
    FILE_DATE,
    FILE_NAME,
    csv_by_header,
    detected_csv,
    leading_date,
    naive_csv,
    reply_rows,
    report_rows,
    scan_parquet,
    trailing_date,
    within_days,
)

_SECOND = timedelta(seconds=1)


@dataclass(frozen=True)
class Extract:
    """One table's run: what to read, since when, and as of when."""

    spark: SparkSession
    job: LandingJob
    spec: TableSpec
    as_of: datetime
    mark: datetime | None = None
    connection: Connection | None = None

    @property
    def source(self) -> str:
        return render_path(self.job.input, **self.job.parts(self.spec))

    def option(self, name: str, default: object = None) -> object:
        return self.spec.options.get(name, default)

    def required(self, name: str) -> object:
        if name not in self.spec.options:
            raise ConfigError(f"table {self.spec.table} needs the option {name!r}")
        return self.spec.options[name]

    @property
    def n_days(self) -> int | None:
        """Days back to the files after the mark; None selects every file."""
        if not self.job.incremental or self.mark is None:
            return None
        return days_since(self.mark, self.as_of)

    def windows(self, whole_days: bool = False) -> DataFrame:
        manual = not self.job.incremental
        about = self.option("daily_extract", {})
        rule = WindowRule(
            frequency="manual" if manual else self.job.frequency,
            days=about.get("days", 1),
            per_day=self.option("time_intervals", 1),
            whole_days=whole_days,
            start=_moment(self.option("start_date")),
            stop=_moment(self.option("end_date")),
        )
        return window_for(self.spark, rule, self.mark, self.as_of)


def _moment(text: object) -> datetime | None:
    return datetime.fromisoformat(str(text)).replace(tzinfo=None) if text else None


def database(run: Extract) -> DataFrame:
    """Rows above the mark, else the configured part, else the whole table.

    ``slice_column`` shares the scan between ``slices`` tasks by the column's range.
    """
    if run.connection is None:
        raise ConfigError("a database table needs a connection")
    name = run.spec.table if "." in run.spec.table else f"{run.spec.schema}.{run.spec.table}"
    condition = run.spec.full_where
    if run.job.incremental and run.spec.has_mark and run.spec.incremental_where:
        condition = incremental_condition(run.spec.incremental_where, run.mark)
    slices: Slices | None = None
    if run.option("slice_column"):
        slices = slice_range(run.spark, run.connection, name, run.option("slice_column"), run.option("slices", 64), condition)
    return read_filtered(run.spark, run.connection, name, condition, slices)


def reports(run: Extract) -> DataFrame:
    """Report CSVs, cut to the run's windows by the report's time column; a first run,
    which has no mark, takes them whole. With ``replies`` they are still in their XML envelopes."""
    if run.option("replies"):
        rows = reply_rows(run.spark, run.source)
    else:
        rows = report_rows(run.spark, run.source, multi_line=run.option("multi_line", True))
    column = run.option("time_column")
    if column and (run.mark is not None or not run.job.incremental):
        rows = rows.withColumn("__moment", F.expr(f"try_cast(`{column}` AS timestamp_ntz)"))
        rows = in_windows_union(rows, "__moment", run.windows()).drop("__moment")
    return rows


def zipped_files(run: Extract) -> DataFrame:
    """CSV members of the archives dated since the mark."""
    name = F.split_part(F.col("path"), F.lit("/"), F.lit(-1))
    rows = zipped_csv(
        run.spark,
        run.source,
        prefix=run.required("prefix"),
        keyword=run.required("keyword"),
        header=run.option("header"),
        name_filter=within_days(leading_date(name), run.as_of.date(), run.n_days),
        spread=run.option("spread"),
    )
    file_name = F.split_part(F.col("path"), F.lit("/"), F.lit(-1))
    dated = rows.withColumn(FILE_DATE, leading_date(file_name).cast("timestamp_ntz"))
    return dated.drop("path", "member")


def dated_files(run: Extract) -> DataFrame:
    """Plain CSVs dated since the mark, in whatever charset each one has."""
    file_date = trailing_date(run.required("prefix"))
    named = F.contains(FILE_NAME, F.lit(run.required("prefix"))) & F.endswith(FILE_NAME, F.lit(run.option("extension", ".csv")))
    wanted = named & within_days(file_date, run.as_of.date(), run.n_days)

    def reader(spark, paths, **options):
        return naive_csv(spark, paths, **options).withColumn(FILE_DATE, file_date)

    return detected_csv(run.spark, run.source, reader, wanted)


def plain_docs(run: Extract) -> DataFrame:
    """Yesterday's flat documents without duplicates."""
    rows = plain_documents(run.spark, run.source, run.option("fields"))
    if run.job.incremental and run.spec.has_mark:
        start, stop = yesterday(run.as_of.date())
        rows = text_time_between(rows, run.spec.mark_column, start, stop - _SECOND)
    return require_documents(distinct_rows(rows.drop(*run.option("drop", []))))


def typed_docs(run: Extract) -> DataFrame:
    """Yesterday's typed documents, decoded, times cut to seconds."""
    text = run.spark.read.text(run.source)
    names = run.option("fields") or field_names(text)
    rows = typed_documents(text, names, id_column=run.option("id_column"))
    mark = run.spec.mark_column
    if mark in rows.columns:
        if run.job.incremental:
            start, stop = yesterday(run.as_of.date())
            zone = run.option("zone", "UTC")
            instant = F.expr(f"try_cast(`{mark}` AS timestamp)")
            bounds = [F.to_utc_timestamp(F.lit(str(b)), zone) for b in (start, stop)]
            rows = rows.where((instant >= bounds[0]) & (instant < bounds[1]))
        rows = rows.withColumn(mark, iso_prefix(mark))
    return rows


def store_reports(run: Extract) -> DataFrame:
    """Every report file with the table's suffix; columns differ between files."""
    return csv_by_header(
        run.spark,
        run.source,
        run.option("variants", {}),
        encoding=run.option("encoding", "UTF-16LE"),
        multi_line=True,
        pathGlobFilter=f"*{run.required('suffix')}",
        recursiveFileLookup=True,
    )


def warehouse_view(run: Extract) -> DataFrame:
    """Rows of an exported view in the run's window; as text where configured."""
    rows = scan_parquet(run.spark, run.source)
    if run.spec.has_mark:
        column = run.spec.mark_column
        if not run.job.incremental:
            rows = in_range(rows, column, _moment(run.required("start_date")), _moment(run.required("end_date")))
        elif run.job.frequency == "hourly":
            rows = newer_than(rows, column, run.mark)
        elif run.mark is not None:
            ends = run.windows(whole_days=True).agg(F.min("start").alias("start"), F.max("stop").alias("stop")).first()
            rows = on_days(rows, column, ends.start, ends.stop) if ends.start else rows.limit(0)
    return stringify_all(rows) if run.option("as_text") else rows


READERS: dict[str, Callable[[Extract], DataFrame]] = {
    "database": database,
    "reports": reports,
    "zipped_files": zipped_files,
    "dated_files": dated_files,
    "plain_documents": plain_docs,
    "typed_documents": typed_docs,
    "store_reports": store_reports,
    "warehouse_view": warehouse_view,
}


def audit_literals(run: Extract) -> dict[str, object]:
    """The job's audit values; report feeds add zone offset and extraction time."""
    literals = {f"_{k.lstrip('_')}": v for k, v in run.job.metadata.items()}
    if run.spec.reader == "reports":
        zones = run.option("zones", ["UTC", "UTC"])
        literals = {**extraction_literals(run.as_of, *zones), **literals}
    return literals
