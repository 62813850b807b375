"""Load each landed file into a bronze table exactly once."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..folding import finish_folds
from ..sinks.kept_marks import Carried
from ..sinks.tables import LOAD_BATCH, align, create_table_if_absent, quoted, replace_partitions
from ..sinks.widening import leaves, merged_schema, places_where
from ..sources.files import PROVENANCE, PROVENANCE_TYPE, header_names, with_provenance

FILES_PER_BATCH = 10_000
# Beyond any file's age: a file restored or copied with its old time is loaded, too. The
# price is that the driver keeps the path of every loaded file while a load runs (some
# hundred bytes each), so archive landing folders before they hold tens of millions.
FILE_AGE = "36500d"
# Reader options by landing format.
READ_OPTIONS = {
    "json": {},
    "csv": {"header": "true", "escape": '"', "enforceSchema": "false"},
    "parquet": {"mergeSchema": "true"},
}
_LISTING = (
    T.StructType()
    .add("path", "string")
    .add("modificationTime", "timestamp")
    .add("length", "long")
    .add("content", "binary")
)
BROKEN = "_broken_line"
RESCUED = "_rescued"
SET_ASIDE = "__set_aside"
SET_ASIDE_COLUMNS = "path string, line string, held string, reason string"
# More bad files than this in one batch look like a store that fails, not like bad files.
MAX_BAD_FILES = 100
# What Spark says of a file it cannot read; anything else that fails a job is no file's fault.
FILE_FAULTS = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "CANNOT_MERGE", "FAILED_MERGE", "MALFORMED", "is not a Parquet file", "Could not read footer")


@dataclass(frozen=True)
class LoadResult:
    """What one load run did; ``set_aside`` counts lines, ``bad_files`` whole files."""

    batches: int
    files: int
    rows: int
    set_aside: int = 0
    bad_files: int = 0


def batch_label(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch that stays the same when it is replayed after a failure.

    The stream's id lives in its checkpoint; batch numbers alone would clash with those
    of an earlier checkpoint.
    """
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream}-{batch_id:08d}"


def new_files(spark: SparkSession, source: str, max_files: int) -> DataFrame:
    """Paths of landed files as a stream; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(_LISTING).options(maxFilesPerTrigger=max_files, maxFileAge=FILE_AGE)
    return reader.load(source).select("path")


def read_batch(
    spark: SparkSession, paths: list[str], source: str, file_format: str, schema: T.StructType | None, **options: str
) -> DataFrame:
    """The files of one micro-batch with their provenance; columns are inferred from these
    files only where no schema is declared."""
    reader = spark.read.format(file_format).options(**{"basePath": source, **READ_OPTIONS[file_format], **options})
    return with_provenance((reader.schema(schema) if schema else reader).load(paths))


# --- JSON --------------------------------------------------------------------


def _json_rows(spark: SparkSession, paths: list[str], source: str, schema: T.StructType | None) -> DataFrame:
    """JSON lines; one that is no JSON, or does not fit its columns, stands in ``BROKEN`` as received."""
    options = {"columnNameOfCorruptRecord": BROKEN}
    if schema is None:
        plain = spark.read.options(basePath=source, **options).json(paths).schema
        schema = _exact_numbers(spark, paths, source, T.StructType([f for f in plain.fields if f.name != BROKEN]))
    declared = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    return read_batch(spark, paths, source, "json", declared, **options)


def _exact_numbers(spark: SparkSession, paths: list[str], source: str, inferred: T.StructType) -> T.StructType:
    """The inferred columns, where doubles that would change a whole number are text instead."""
    as_text = _replaced(inferred, T.DoubleType(), T.StringType())
    places = leaves(as_text, inferred, lambda held, other: isinstance(other, T.DoubleType))
    if not places:
        return inferred
    exact = T.DecimalType(38, 0)
    long = lambda c: c.rlike(r"^-?[0-9]{16,}$") & (c.try_cast(exact) != c.cast("double").try_cast(exact))
    changed = places_where(spark.read.options(basePath=source).schema(as_text).json(paths), places, long)
    return _replaced(inferred, T.DoubleType(), T.StringType(), changed)


def _replaced(kind: T.DataType, old: T.DataType, new: T.DataType, only: set[str] | None = None, where: str = "") -> T.DataType:
    """A type with its ``old`` leaves as ``new`` ones, at the places named or everywhere."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _replaced(f.dataType, old, new, only, f"{where}.{f.name}" if where else f.name), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_replaced(kind.elementType, old, new, only, f"{where}[]"), True)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _replaced(kind.valueType, old, new, only, f"{where}{{}}"), True)
    return new if kind == old and (only is None or where in only) else kind


# --- CSV ---------------------------------------------------------------------


def _csv_lines(spark: SparkSession, paths: list[str], source: str) -> tuple[DataFrame, DataFrame]:
    """The lines of CSV files with ``row`` in order, and each file's header: ``path, first, header``."""
    lines = with_provenance(spark.read.option("basePath", source).text(paths).where(F.trim("value") != "")).select(
        F.col("value").alias("line"), PROVENANCE, F.monotonically_increasing_id().alias("row")
    )
    place = F.col(PROVENANCE)
    heads = lines.where(place["file_block_start"] == 0).groupBy(place["file_path"].alias("path")).agg(F.min("row").alias("first"), F.regexp_replace(F.min_by("line", "row"), "^\ufeff", "").alias("header"))
    return lines, heads


def _csv_rows(spark: SparkSession, paths: list[str], source: str, schema: T.StructType | None) -> DataFrame:
    """CSV files in one scan, each line read under its own file's header, columns united by name.

    Columns that a declared schema lacks go to ``RESCUED`` as JSON; a line with more fields than
    its header, or with a value that is not of its column's type, stands in ``BROKEN``.
    """
    lines, heads = _csv_lines(spark, paths, source)
    headers = [r.header for r in heads.groupBy("header").agg(F.min("path").alias("path")).orderBy("path").collect()]
    if not headers:
        columns = T.StructType([*(schema.fields if schema else []), T.StructField(PROVENANCE, PROVENANCE_TYPE), T.StructField(BROKEN, T.StringType())])
        return spark.createDataFrame([], columns)
    named = {h: header_names(h) for h in headers}
    found: dict[str, str] = {}
    for names in named.values():
        for n in names:
            found.setdefault(n.lower(), n)
    fields = schema.fields if schema else [T.StructField(n, T.StringType()) for n in found.values()]
    known = {f.name.lower() for f in fields}
    extra = [n for low, n in found.items() if low not in known]
    wanted = [f.name for f in fields] + extra

    def places(names: list[str]) -> list[int | None]:
        at = {n.lower(): i for i, n in enumerate(names)}
        return [at.get(n.lower()) for n in wanted]

    layouts = spark.createDataFrame([(h, places(n), len(n)) for h, n in named.items()], "header string, places array<int>, width int")
    width = max(map(len, named.values())) + 1  # one field more shows that a line is too wide
    tokens = F.from_csv("line", ", ".join(f"c{i} string" for i in range(width)), {"escape": '"'})
    rows = (
        lines.join(heads.join(layouts, "header"), F.col(PROVENANCE)["file_path"] == F.col("path"))
        .where("row <> first")
        .withColumn("parsed", tokens)
        .withColumn("fields", F.array(*(F.col("parsed")[f"c{i}"] for i in range(width))))
    )
    raw = {n: F.get("fields", F.get("places", F.lit(i))) for i, n in enumerate(wanted)}
    values, misfits = [], F.get("fields", F.col("width")).isNotNull()
    for f in fields:
        if f.dataType == T.StringType():
            values.append(raw[f.name].alias(f.name))
            continue
        text = F.nullif(raw[f.name], F.lit(""))
        value = text.try_cast(f.dataType)
        values.append(value.alias(f.name))
        misfits = misfits | (text.isNotNull() & value.isNull())
    rescued = [F.nullif(F.to_json(F.struct(*(raw[n].alias(n) for n in extra))), F.lit("{}")).alias(RESCUED)] if extra else []
    return rows.select(*values, *rescued, PROVENANCE, F.when(F.coalesce(misfits, F.lit(False)), F.col("line")).alias(BROKEN))


def _csv_multi_line(spark: SparkSession, paths: list[str], source: str, schema: T.StructType | None) -> DataFrame:
    """CSV files whose fields hold line breaks: a scan for each header, one task a file."""
    _, heads = _csv_lines(spark, paths, source)
    groups: dict[str, list[str]] = {}
    for row in heads.toLocalIterator():
        groups.setdefault(row.header, []).append(row.path)
    frames = []
    for header, members in sorted(groups.items()):
        own = T.StructType([T.StructField(n, T.StringType()) for n in header_names(header)])
        rows = read_batch(spark, members, source, "csv", own, multiLine="true", enforceSchema="true")
        if schema:
            held = {n.lower(): n for n in own.names}
            rest = [n for n in own.names if n.lower() not in {f.name.lower() for f in schema.fields}]
            cells = [F.nullif(F.col(f"`{held[f.name.lower()]}`"), F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema.fields if f.name.lower() in held]
            rescued = [F.nullif(F.to_json(F.struct(*(f"`{n}`" for n in rest))), F.lit("{}")).alias(RESCUED)] if rest else []
            rows = rows.select(*cells, *rescued, PROVENANCE)
        frames.append(rows)
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return united.withColumn(BROKEN, F.lit(None).cast("string"))


# --- files that cannot be read -----------------------------------------------


def is_file_fault(error: Exception) -> bool:
    """Whether an error is about what a file holds: then other files may still be loaded."""
    if isinstance(error, AnalysisException | ValueError):
        return True
    return any(code in str(error) for code in FILE_FAULTS)


def _reason(error: Exception) -> str:
    """The first line that says what is wrong with a file, else the first line."""
    told = str(error)
    named = [m for m in re.findall(r"\[[A-Z_.]+\] [^\n]*", told) if any(code in m for code in FILE_FAULTS)]
    return (named or [told.strip().partition("\n")[0]])[0][:500]


def isolate(
    read: Callable[[list[str]], DataFrame], paths: Sequence[str], held: T.StructType | None
) -> tuple[list[list[str]], list[tuple[str, str]], T.StructType | None]:
    """Groups of files that can be read and held together with ``held``, and the others with the reason.

    Halves are tried, so a few bad files among many cost a few scans of their neighbours. Of files
    that exclude each other, in a table that has neither's columns yet, the first by name stays.
    """
    try:
        rows = read(list(paths))
        merged = rows.schema if held is None else merged_schema(held, rows.schema)
        rows.write.format("noop").mode("overwrite").save()
        return [list(paths)], [], merged
    except Exception as error:  # noqa: BLE001 - a fault of the store is raised again
        if not is_file_fault(error):
            raise
        if len(paths) == 1:
            return [], [(paths[0], _reason(error))], held
    middle = len(paths) // 2
    good, bad, held = isolate(read, paths[:middle], held)
    more, worse, held = isolate(read, paths[middle:], held)
    return good + more, bad + worse, held


def _united(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several reads under the columns and types that hold them all."""
    if len(frames) == 1:
        return frames[0]
    wanted = reduce(merged_schema, (f.schema for f in frames))
    return reduce(lambda a, b: a.unionByName(b), (align(f, wanted) for f in frames))


# --- the load ----------------------------------------------------------------


def copy_into(
    spark: SparkSession,
    table: str,
    location: str,
    source: str,
    checkpoint: str,
    file_format: str = "json",
    schema: T.StructType | None = None,
    max_files: int = FILES_PER_BATCH,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    multi_line: bool = False,
    on_loaded: Callable[[str], None] | None = None,
) -> LoadResult:
    """Append the files not loaded before to a table, and stop.

    A stream of file names finds what is new; its checkpoint knows the loaded files.
    Each micro-batch (``max_files`` at most, so the driver's list of names is bounded)
    is read as a batch and becomes one partition of the table. A replay replaces that
    partition, so a crash between data and checkpoint leaves no duplicates. New columns
    are added to the table, and ``shape`` may transform a batch first. CSV files are read
    under their own headers and united by name. ``multi_line`` is for CSV whose fields
    hold line breaks; each such file is then read by one task. ``on_loaded`` is called with
    a batch's label when its rows are written, before it counts as loaded.

    What cannot be loaded does not stop the rest: broken lines and unreadable files go to the
    table ``<table>__set_aside`` (``path, line, held, reason``; ``line`` is null for a whole file),
    from where ``set_aside`` reads them. More than ``MAX_BAD_FILES`` of a batch stop the load.
    """
    done: dict[str, tuple[int, int, int, int]] = {}

    def read(paths: list[str]) -> DataFrame:
        if file_format == "json":
            return _json_rows(spark, paths, source, schema)
        if file_format == "csv":
            return (_csv_multi_line if multi_line else _csv_rows)(spark, paths, source, schema)
        return read_batch(spark, paths, source, file_format, schema).withColumn(BROKEN, F.lit(None).cast("string"))

    def write(label: str, frames: Sequence[DataFrame]) -> tuple[int, int]:
        """Rows written, and lines that are broken."""
        seen = Observation()
        broken = F.count_if(F.col(BROKEN).isNotNull()).alias("broken")
        counted = _united(frames).observe(seen, F.count(F.lit(1)).alias("n"), broken)
        good = counted.where(F.col(BROKEN).isNull()).drop(BROKEN)
        rows = (shape(good) if shape else good).withColumn(LOAD_BATCH, F.lit(label))
        create_table_if_absent(spark, table, rows.schema, location, [LOAD_BATCH])
        kept, marks = Observation(), Carried(spark, table)
        replace_partitions(spark, table, rows.observe(kept, F.count(F.lit(1)).alias("n"), *marks.measures(rows)))
        marks.keep(kept.get)
        return kept.get["n"], seen.get["broken"]

    def load(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(batch, batch_id)
        paths = sorted(row.path for row in batch.collect())
        if not paths:
            return
        groups, bad = [paths], []
        try:
            n, broken = write(label, [read(paths)])
        except Exception as error:  # noqa: BLE001 - only what files hold is set aside
            if not is_file_fault(error):
                raise
            held = spark.table(quoted(table)).schema if spark.catalog.tableExists(quoted(table)) else None
            shaped = (lambda some: shape(read(some))) if shape else read
            groups, bad, _ = isolate(shaped, paths, held)
            if len(bad) > MAX_BAD_FILES or (not bad and len(groups) == 1):
                raise
            n, broken = write(label, [read(g) for g in groups]) if groups else (0, 0)
        if broken or bad:
            lines = [_broken_lines(read(g)) for g in groups] if broken else []
            files = [spark.createDataFrame([(p, None, None, r) for p, r in bad], SET_ASIDE_COLUMNS)] if bad else []
            aside = reduce(DataFrame.unionByName, lines + files).withColumn(LOAD_BATCH, F.lit(label))
            create_table_if_absent(spark, f"{table}{SET_ASIDE}", aside.schema, f"{location.rstrip('/')}.set_aside", [LOAD_BATCH])
            replace_partitions(spark, f"{table}{SET_ASIDE}", aside)
        done[label] = (len(paths), n, broken, len(bad))
        if on_loaded:
            on_loaded(label)

    finish_folds(spark, table)
    query = (
        new_files(spark, source, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if schema and shape is None:  # a first run without files still leaves a table to query
        columns = T.StructType([*schema.fields, T.StructField(PROVENANCE, PROVENANCE_TYPE), T.StructField(LOAD_BATCH, T.StringType())])
        create_table_if_absent(spark, table, columns, location, [LOAD_BATCH])
    files, rows, lines, bad = (sum(c) for c in zip(*done.values())) if done else (0, 0, 0, 0)
    return LoadResult(len(done), files, rows, lines, bad)


def _broken_lines(rows: DataFrame) -> DataFrame:
    """``path, line, held, reason`` of the broken lines of a read; ``held``: what could be read of a line, as JSON."""
    others = [F.col(f"`{c}`") for c in rows.columns if c not in (BROKEN, PROVENANCE)]
    held = F.to_json(F.struct(*others)) if others else F.lit("{}")
    return rows.where(F.col(BROKEN).isNotNull()).select(
        F.col(PROVENANCE)["file_path"].alias("path"), F.col(BROKEN).alias("line"), held.alias("held"), F.lit("broken line").alias("reason")
    )


def set_aside(spark: SparkSession, table: str) -> DataFrame:
    """``path, line, held, reason`` of all that a table's loads have set aside; ``line`` is null for whole files."""
    name = quoted(f"{table}{SET_ASIDE}")
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], SET_ASIDE_COLUMNS)
    return spark.table(name).drop(LOAD_BATCH)
