"""Config-driven runs: land every table, load every table, maintain every table."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .config import BronzeJob, LandingJob, MaintenanceJob, TableSpec, render_path
from .functions.audit import with_audit
from .functions.names import assert_legal_names, clean_column_names
from .maintenance import maintain
from .operators.ledger import append_paths, fold_ledger
from .operators.marks import last_mark
from .plans.feeds import READERS, Extract, audit_literals
from .retry import retry
from .shared import new_folder, settled_batch
from .sinks.files import WriteMode, write_files
from .sinks.kept_marks import text_mark
from .sinks.tables import quoted, replace_table, set_table_note, staged_publish, table_note
from .sources.databases import Connection, jdbc_url, resolve_engine
from .sources.files import NoFiles, scan_csv, with_provenance
from .streaming.load import FILES_PER_BATCH, READ_OPTIONS, copy_into
from .streaming.messages import IngestResult, drain_messages, load_unread

log = logging.getLogger(__name__)


def table_mark(spark: SparkSession, job: LandingJob, spec: TableSpec, as_of: datetime) -> datetime | None:
    """Mark of the bronze table, or None where there is no table, no row or no mark column.

    A mark over a time column is kept with the table, and the next lookup starts from it.
    One over text is kept by the loads themselves, so that only the first lookup reads the table.
    """
    name = job.bronze_name(spec)
    if not (job.incremental and spec.has_mark and spark.catalog.tableExists(quoted(name))):
        return None
    column = spec.options.get("bronze_mark_column", spec.mark_column)
    pattern = spec.options.get("mark_pattern")
    table = spark.table(quoted(name))
    if table.schema[column].dataType == T.StringType():
        return text_mark(spark, name, column, pattern, as_of)
    kept = table_note(spark, name, f"mark.{column}")
    mark = last_mark(table, column, as_of, pattern, datetime.fromisoformat(kept) if kept else None)
    if isinstance(mark, datetime) and mark.isoformat() != kept:
        set_table_note(spark, name, f"mark.{column}", mark.isoformat())
    return mark


def job_connection(
    job: LandingJob, host: str, port: str | int, user: str, password: str, sqlserver_names: Iterable[str] = (), **more: object
) -> Connection:
    """The database of a landing job: engine and address as the job has them, else by the database's name."""
    engine = resolve_engine(job.db_name, job.engine, sqlserver_names)
    return Connection(jdbc_url(engine, host, port, job.db_name), user, password, **more)


def land_table(
    spark: SparkSession, job: LandingJob, spec: TableSpec, as_of: datetime, connection: Connection | None = None
) -> bool:
    """Extract one table and write its landing files; False when there was nothing new.

    The extract runs once, into a settled batch; the emptiness check (one row), the row
    count (file footers) and the landing write all work on that batch.
    """
    run = Extract(spark, job, spec, as_of, table_mark(spark, job, spec, as_of), connection)
    try:
        extract = READERS[spec.reader](run)
    except NoFiles as none:
        log.warning("%s.%s: %s", spec.schema, spec.table, none)
        return False
    with settled_batch(spark, extract, "extract") as batch:
        if batch.isEmpty():
            log.warning("%s.%s: nothing new", spec.schema, spec.table)
            return False
        write_files(
            with_audit(batch, audit_literals(run)),
            render_path(job.outputs, **job.parts(spec)),
            file_format=spec.file_format,
            mode=spec.write_mode,
            files=spec.options.get("files"),
        )
    return True


def run_landing(
    spark: SparkSession, job: LandingJob, as_of: datetime, connection: Connection | None = None
) -> dict[str, bool]:
    return {f"{s.schema}.{s.table}": land_table(spark, job, s, as_of, connection) for s in job.tables}


def load_table(spark: SparkSession, job: BronzeJob, spec: TableSpec) -> str:
    """Bring one table's landing files into bronze, by its mode; returns the table's name."""
    parts, name = job.parts(spec), job.bronze_name(spec)
    source = render_path(job.input_path, **parts)
    location = render_path(job.location, **parts)
    multi_line = bool(spec.options.get("multi_line"))  # fields of this feed hold line breaks
    if spec.options.get("clean_names"):
        cleaned = assert_legal_names(clean_column_names(scan_csv(spark, source, escape='"', multiLine=multi_line)))
        staged_publish(spark, name, cleaned, new_folder(spark, "staging"), location)
    elif spec.mode is WriteMode.OVERWRITE:
        rows = spark.read.format(spec.file_format).options(**READ_OPTIONS[spec.file_format], multiLine=multi_line and spec.file_format == "csv").load(source)
        replace_table(spark, name, with_provenance(rows), location)
    else:
        copy_into(
            spark,
            name,
            location,
            source,
            render_path(job.checkpoints, **parts),
            spec.file_format,
            T.StructType.fromJson(spec.options["columns"]) if "columns" in spec.options else None,
            spec.options.get("max_files", FILES_PER_BATCH),
            multi_line=multi_line,
        )
    return name


def run_bronze(spark: SparkSession, job: BronzeJob) -> list[str]:
    return [load_table(spark, job, spec) for spec in job.tables]


def land_queue(
    spark: SparkSession,
    source: str,
    landing: str,
    checkpoint: str,
    ledger_path: str,
    queue: str,
    env: str,
    schema: T.StructType,
    at: datetime,
    tries: int = 15,
    **options: object,
) -> IngestResult:
    """Drain the waiting message files; each landed folder goes into the ledger before
    its batch counts as taken. A folder noted twice after a failure is still one path.
    The queue's ledger is folded afterwards, where it has grown many files."""

    def note(folder: str) -> None:
        retry(lambda: append_paths(spark, ledger_path, queue, env, [folder], False, at), tries)

    drained = drain_messages(spark, source, landing, checkpoint, schema, on_landed=note, **options)
    if drained.paths:
        retry(lambda: fold_ledger(spark, ledger_path, queue, env), tries)
    return drained


def load_queue(
    spark: SparkSession,
    ledger_path: str,
    queue: str,
    env: str,
    table: str,
    location: str,
    body: T.StructType,
    at: datetime,
    **options: object,
) -> list[str]:
    """Load what the ledger holds unread; returns the folders loaded."""
    return load_unread(spark, ledger_path, queue, env, table, location, body, at, **options)


def run_maintenance(spark: SparkSession, job: MaintenanceJob) -> DataFrame:
    return maintain(spark, catalogs=job.catalogs, hours=job.retention_hours)
