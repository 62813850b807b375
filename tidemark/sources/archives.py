"""CSV members inside ZIP archives.

An archive's table of contents says where each member begins, so members are read one by one, each
once and by the task it is dealt to: an archive of many members gives work to many tasks, and no
task holds more than a member's stream. Workers open the archives themselves, in any store that
pyarrow's file systems know (local and shared folders, HDFS, S3, GCS, ABFS).
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import settled
from .files import NoFiles, by_position

LINES_SCHEMA = "path string, member string, line_no bigint, line string, layout int"
_ARROW_LINES = pa.schema(
    [("path", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("line", pa.string()), ("layout", pa.int32())]
)
_BATCH_LINES = 20_000
TASK_BYTES = 32 << 20  # packed bytes of members that one task is dealt
#: Names that Spark's and pyarrow's file systems do not share.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}


def open_archive(path: str) -> zipfile.ZipFile:
    """An archive in a shared store, read by seeking."""
    scheme, found, rest = path.partition(":")
    if not found or scheme == "file":
        return zipfile.ZipFile(pa.fs.LocalFileSystem().open_input_file("/" + (rest if found else path).lstrip("/")))
    store, place = pa.fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    return zipfile.ZipFile(store.open_input_file(place))


def member_selected(
    member: Column | str, prefix: Column | str, keyword: Column | str, extension: str = ".csv"
) -> Column:
    """Member-name rule: prefix and extension fit, and the keyword is in both the
    member (any case) and the prefix, or in neither."""
    name = F.col(member) if isinstance(member, str) else member
    start = F.lit(prefix) if isinstance(prefix, str) else prefix
    word = F.lit(keyword) if isinstance(keyword, str) else keyword
    return (
        F.startswith(name, start)
        & F.endswith(name, F.lit(extension))
        & (F.contains(F.lower(name), word) == F.contains(start, word))
    )


def zip_members(
    spark: SparkSession, folder: str, prefix: str, keyword: str, extension: str = ".csv", name_filter: Column | None = None
) -> DataFrame:
    """``path, member, packed`` of every selected member; only tables of contents are read.

    ``name_filter`` may use ``path``, ``modificationTime`` and ``length``; other archives stay unopened.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("path", "modificationTime", "length")
    if name_filter is not None:
        archives = archives.where(name_filter)

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_archive(path) as archive:
                    found = [(path, m.filename, m.compress_size) for m in archive.infolist()]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["path", "member", "packed"])

    listed = archives.select("path").mapInArrow(contents, "path string, member string, packed bigint")
    return settled(spark, listed.where(member_selected("member", prefix, keyword, extension)), "members")


def zip_lines(spark: SparkSession, members: DataFrame, heads_only: bool = False, headers: Sequence[str] = ()) -> DataFrame:
    """One row per text line of the members listed: ``path, member, line_no, line, layout``.

    ``layout`` is the place of the member's own first line in ``headers`` (-1 where it is not
    there), so a header travels with its lines. ``heads_only`` stops after the first line.
    """
    places = {h: i for i, h in enumerate(headers)}
    size = members.agg(F.coalesce(F.sum("packed"), F.lit(0)), F.count("*")).first()
    tasks = max(1, min(size[1], -(-size[0] // TASK_BYTES)))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member in zip(*(batch.column(k).to_pylist() for k in range(2))):
                with open_archive(path) as archive, archive.open(member) as packed:
                    for found in _line_batches(path, member, packed, 1 if heads_only else _BATCH_LINES, places):
                        yield found
                        if heads_only:
                            break

    return members.select("path", "member").repartition(tasks).mapInArrow(unpack, LINES_SCHEMA)


def _line_batches(path: str, member: str, packed, size: int, places: dict[str, int]) -> Iterator[pa.RecordBatch]:
    lines: list[str] = []
    done, layout = 0, None
    for raw in io.TextIOWrapper(packed, encoding="utf-8"):
        lines.extend(raw.splitlines())
        if layout is None and lines:
            layout = places.get(lines[0], -1)
        if len(lines) >= size:
            yield _line_batch(path, member, done, lines, layout)
            done += len(lines)
            lines = []
    if lines:
        yield _line_batch(path, member, done, lines, layout)


def _line_batch(path: str, member: str, done: int, lines: list[str], layout: int) -> pa.RecordBatch:
    n = len(lines)
    columns = [[path] * n, [member] * n, range(done + 1, done + n + 1), lines, [layout] * n]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ARROW_LINES)], schema=_ARROW_LINES)


def zipped_csv(
    spark: SparkSession,
    folder: str,
    prefix: str,
    keyword: str,
    header: str | None = None,
    name_filter: Column | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Rows of the selected members, split at plain commas; rows ragged against their own member's header are dropped.

    Columns go by position under the header of the first member by name where a member's
    header fits it (``files.by_position``), else by name; a column that a member lacks is
    empty text. Under a given ``header`` all go by position, and a member of another width
    raises. ``spread`` deals the lines out over that many tasks before parsing, for a feed
    where a few members hold most of the rows. Distinct headers come to the driver.
    """
    members = zip_members(spark, folder, prefix, keyword, name_filter=name_filter)
    heads = zip_lines(spark, members, heads_only=True).where("line_no = 1")
    found = [r.line for r in heads.groupBy("line").agg(F.min(F.struct("path", "member")).alias("at")).orderBy("at").collect()]
    if not found and header is None:
        raise NoFiles(f"no member of {folder} fits {prefix!r} and {keyword!r}")
    own = {h: [n.replace(" ", "_") for n in h.split(",")] for h in found}
    first = [n.replace(" ", "_") for n in header.split(",")] if header is not None else own[found[0]]
    names = list(first)
    places: list[list[int | None]] = []
    for h in found:
        cells = own[h]
        if header is not None and len(cells) != len(first):
            raise ValueError(f"the header given has {len(first)} columns, a member of {folder} another number: {h!r}")
        if header is not None or by_position(first, cells):
            places.append(list(range(len(first))))
            continue
        low = [n.lower() for n in cells]
        if len(set(low)) < len(low):
            raise ValueError(f"a member of {folder} repeats a column and differs from the others: {h!r}")
        names += [n for n in cells if n.lower() not in {x.lower() for x in names}]
        places.append([low.index(n.lower()) if n.lower() in low else None for n in names])
    rows = zip_lines(spark, members, headers=found).where("line_no > 1").select("path", "member", "line", "layout")
    if spread:
        rows = rows.repartition(spread)
    fields = F.split("line", ",", -1)
    # literals: one number for each header and column
    at = F.lit([[-1 if p is None else p for p in (*ps, *[None] * (len(names) - len(ps)))] for ps in places] or [[-1]])
    width = F.lit([len(own[h]) for h in found] or [0])
    kept = rows.withColumn("fields", fields).where(F.size("fields") == F.get(width, F.col("layout"))).withColumn("at", F.get(at, F.col("layout")))
    cells = [F.coalesce(F.get("fields", F.get("at", F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(names)]
    return kept.select(*cells, "path", "member")
