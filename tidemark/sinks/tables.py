"""Published tables: external Parquet tables in the session catalog, one writer each."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import filesystem
from ..sources.files import scan_json
from .files import write_files
from .widening import fitted, inexact_places, merged_schema

LOAD_BATCH = "_load_batch"  # the partition column of tables that loads write, one value a micro-batch
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
VERSION_PREFIX = "version-"
NOTE = "tidemark."
WRITTEN = "written"  # changes with every write, once a mark is kept that depends on it
FIRST_LOCATION, FIRST_REPLACED = "first_location", "first_replaced"
VERSION_STAMP = "%Y%m%dT%H%M%S%f"


def quoted(name: str) -> str:
    """``schema.table`` or ``catalog.schema.table`` with each part in backticks."""
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def create_table_if_absent(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    partition_by: Sequence[str] = (),
) -> bool:
    """Create the schema and the external table where missing; True if it was created.

    The columns are stated, because a table over an empty folder has none to infer.
    """
    if spark.catalog.tableExists(quoted(name)):
        return False
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name.rpartition('.')[0])}")
    layout = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({_ddl(schema)}) USING parquet {layout} LOCATION {_literal(location)}")
    return True


def _ddl(schema: T.StructType) -> str:
    """Columns for a CREATE TABLE; every name is quoted, also nested ones."""

    def kind(t: T.DataType) -> str:
        if isinstance(t, T.StructType):
            return "struct<" + ", ".join(f"`{_tick(f.name)}`: {kind(f.dataType)}" for f in t.fields) + ">"
        if isinstance(t, T.ArrayType):
            return f"array<{kind(t.elementType)}>"
        if isinstance(t, T.MapType):
            return f"map<{kind(t.keyType)}, {kind(t.valueType)}>"
        return t.simpleString()

    return ", ".join(f"`{_tick(f.name)}` {kind(f.dataType)}" for f in schema.fields)


def _literal(text: str) -> str:
    """Text as SQL has it."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _tick(name: str) -> str:
    return name.replace("`", "``")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(quoted(name)) if c.isPartition]


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Location'")
    return rows.first().data_type


def table_note(spark: SparkSession, name: str, key: str) -> str | None:
    """A small fact kept with the table as a property; None where there is none."""
    return table_notes(spark, name).get(key)


def table_notes(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
    return {row.key.removeprefix(NOTE): row.value for row in rows if row.key.startswith(NOTE)}


def set_table_note(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ('{NOTE}{key}' = {_literal(value)})")


def touch(spark: SparkSession, name: str) -> None:
    """Say that the rows change, before and after a write. Marks kept with a table hold for one value only."""
    if table_note(spark, name, WRITTEN):
        set_table_note(spark, name, WRITTEN, uuid.uuid4().hex)


@contextmanager
def changing(spark: SparkSession, name: str) -> Iterator[None]:
    touch(spark, name)
    try:
        yield
    finally:
        touch(spark, name)


def evolve_schema(spark: SparkSession, name: str, rows: DataFrame) -> list[str]:
    """Make the table hold the rows that are coming; returns the names of new columns.

    New columns are added, and new fields inside structures declared: older rows read null
    there, and no data is touched. Where a type must widen (whole numbers, then fractions),
    the rows go to a new version of the table in the wider type. Longs that would lose digits
    beside fractions become text with them. Nothing is ever narrowed.
    """
    table = spark.table(quoted(name))
    known = table.schema
    wanted = merged_schema(known, rows.schema, inexact=inexact_places(table, rows))
    names = {f.name.lower() for f in known.fields}
    new = [f for f in wanted.fields if f.name.lower() not in names]
    keys = partition_columns(spark, name)
    changed = [(f.dataType, w.dataType) for f, w in zip(known.fields, wanted.fields) if f.dataType != w.dataType]
    if not changed:
        if new:
            spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({_ddl(T.StructType(new))})")
        return [f.name for f in new]
    ordered = T.StructType([f for f in wanted.fields if f.name not in keys] + [wanted[k] for k in keys])
    if any(_rewritten(old, wide) for old, wide in changed):
        rows = align(spark.table(quoted(name)), ordered)
        replace_table(spark, name, rows, version_root(spark, name), keys)
    else:
        publish_version(spark, name, ordered, table_location(spark, name), keys)
    return [f.name for f in new]


def _rewritten(old: T.DataType, wide: T.DataType) -> bool:
    """Whether files of the old type cannot be read as the wider one: more fields can, other scalars not."""
    if isinstance(old, T.StructType) and isinstance(wide, T.StructType):
        held = {f.name: f.dataType for f in old.fields}
        return any(f.name in held and _rewritten(held[f.name], f.dataType) for f in wide.fields)
    if isinstance(old, T.ArrayType) and isinstance(wide, T.ArrayType):
        return _rewritten(old.elementType, wide.elementType)
    if isinstance(old, T.MapType) and isinstance(wide, T.MapType):
        return _rewritten(old.valueType, wide.valueType)
    return old != wide


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the table's order and types, which must be as wide; those the batch lacks are null."""
    held = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        own = held.get(f.name.lower())
        value = F.lit(None).cast(f.dataType) if own is None else fitted(F.col(f"`{_tick(own.name)}`"), own.dataType, f.dataType)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def append_evolving(spark: SparkSession, name: str, df: DataFrame) -> list[str]:
    """Append by column name, first adding the columns the table lacks."""
    added = evolve_schema(spark, name, df)
    with changing(spark, name):
        align(df, spark.table(quoted(name)).schema).write.insertInto(quoted(name))
    return added


def replace_partitions(spark: SparkSession, name: str, df: DataFrame, gather: bool = False) -> None:
    """Write the partitions found in ``df``, replacing exactly those.

    The same batch written again leaves the same table: the base of every load that
    may be repeated after a failure. Where rows of many partitions lie mixed, ``gather``
    first rebalances them by partition: few files each, a hot one shared between tasks.
    """
    keys = partition_columns(spark, name)
    if not keys:
        raise ValueError(f"{name} has no partitions to replace")
    evolve_schema(spark, name, df)
    aligned = align(df, spark.table(quoted(name)).schema)
    if gather:
        aligned = aligned.hint("rebalance", *keys)
    with changing(spark, name), overwriting_partitions(aligned.sparkSession):
        aligned.write.mode("overwrite").insertInto(quoted(name))
    # a stream writes in a session of its own; the caller's may still list the old files
    spark.catalog.refreshTable(quoted(name))


@contextmanager
def overwriting_partitions(spark: SparkSession) -> Iterator[None]:
    """Dynamic partition overwrite for one write.

    A catalog table takes this mode from the session, not from a writer option; without
    it an overwrite would empty the table.
    """
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def _short(name: str) -> str:
    """``schema.table``, with or without a catalog before it."""
    return ".".join(name.replace("`", "").split(".")[-2:])


def new_version(root: str, name: str, at: datetime | None = None) -> str:
    """A version folder of a table that no other write uses; it carries the table's name
    and the time it was begun."""
    stamp = (at or datetime.now(timezone.utc)).strftime(VERSION_STAMP)
    return f"{root.rstrip('/')}/{VERSION_PREFIX}{_short(name)}-{stamp}-{uuid.uuid4().hex[:8]}"


def version_time(folder: str, name: str) -> datetime | None:
    """When a version folder of this table was begun; None for any other folder."""
    fits = re.fullmatch(rf"{VERSION_PREFIX}{re.escape(_short(name))}-(\d{{8}}T\d{{12}})-[0-9a-f]{{8}}", folder)
    return datetime.strptime(fits[1], VERSION_STAMP).replace(tzinfo=timezone.utc) if fits else None


def version_root(spark: SparkSession, name: str) -> str:
    """Where a table's versions live: beside its current version, or in a folder of its
    own next to its first location."""
    location = table_location(spark, name).rstrip("/")
    parent, _, last = location.rpartition("/")
    return parent if version_time(last, name) else f"{location}.versions"


def publish_version(
    spark: SparkSession, name: str, schema: T.StructType, location: str, partition_by: Sequence[str] = ()
) -> None:
    """Point the table at a finished version.

    Same columns: the location changes in one catalog call. Other columns, or
    partitions: the table (never its data) is dropped and created again, with the notes
    kept on it. A location that is no version folder is noted when it is replaced, so that
    it can expire like one.
    """
    notes, listed = {}, None
    if spark.catalog.tableExists(quoted(name)):
        touch(spark, name)
        notes = table_notes(spark, name)
        before = table_location(spark, name).rstrip("/")
        if not version_time(before.rsplit("/", 1)[-1], name) and not f"{location.rstrip('/')}/".startswith(f"{before}/"):
            notes |= {FIRST_LOCATION: before, FIRST_REPLACED: datetime.now(timezone.utc).isoformat()}
        same_place = before == location.rstrip("/")
        listed = [r.partition for r in spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect()] if partition_by and same_place else None
        old = spark.table(quoted(name)).schema
        same = [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in schema]
        if same and not partition_by and not partition_columns(spark, name):
            spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION {_literal(location)}")
            _note_all(spark, name, notes)
            touch(spark, name)
            spark.catalog.refreshTable(quoted(name))
            return
        spark.sql(f"DROP TABLE {quoted(name)}")
    create_table_if_absent(spark, name, schema, location, partition_by)
    if listed is not None:  # folders that folding took out of the table must not come back
        add_partitions(spark, name, listed)
    elif partition_by:
        spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")
    _note_all(spark, name, notes)
    touch(spark, name)
    spark.catalog.refreshTable(quoted(name))


_SPECS = 500  # partitions in one statement


def partition_spec(listed: str) -> str:
    """``k=v/l=w``, as partitions are listed, as SQL has it."""
    parts = (part.split("=", 1) for part in listed.split("/"))
    return ", ".join(f"`{k}`={_literal(unquote(v))}" for k, v in parts)


def add_partitions(spark: SparkSession, name: str, listed: Sequence[str]) -> None:
    """Make folders below the table's location partitions of it; those that are stay."""
    for i in range(0, len(listed), _SPECS):
        specs = " ".join(f"PARTITION ({partition_spec(p)})" for p in listed[i : i + _SPECS])
        spark.sql(f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS {specs}")


def drop_partitions(spark: SparkSession, name: str, listed: Sequence[str]) -> None:
    """Take partitions out of the table; their files stay."""
    for i in range(0, len(listed), _SPECS):
        specs = ", ".join(f"PARTITION ({partition_spec(p)})" for p in listed[i : i + _SPECS])
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS {specs}")


def _note_all(spark: SparkSession, name: str, notes: dict[str, str]) -> None:
    for key, value in notes.items():
        set_table_note(spark, name, key, value)


def replace_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    max_records: int | None = None,
) -> str:
    """Replace a table's rows and columns; returns the new version's folder.

    Rows go to a new folder first, so readers keep the old version until the new one
    is complete, and a failed write changes nothing.
    """
    location = new_version(root, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(location)
    last = set(partition_by)
    ordered = [f for f in df.schema if f.name not in last] + [df.schema[c] for c in partition_by]
    publish_version(spark, name, T.StructType(ordered), location, partition_by)
    return location


def staged_publish(
    spark: SparkSession, name: str, df: DataFrame, staging: str, root: str
) -> str:
    """Write the batch to its own staging folder as JSON, then replace the table from it.

    The staging folder is per table and per run, so tables cannot mix; it goes when the
    table is published, and stays for a look where that failed.
    """
    write_files(df, staging, "json", "overwrite")
    location = replace_table(spark, name, scan_json(spark, staging, df.schema), root)
    fs, path = filesystem(spark, staging)
    fs.delete(path, True)
    return location
