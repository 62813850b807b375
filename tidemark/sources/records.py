"""CSV records with line breaks inside fields, read by many tasks a file.

Spark splits text at line breaks, so a record may be cut into lines and its lines may lie in two
splits. Whether a line begins inside quotes depends on the quotes before it in its file only: the
parity of quotes is counted for each split, a running sum over a file's splits says how each one
begins, and then every task puts its own lines together. What hangs over a split's edge (one piece
at each end) is put together by a join of those pieces alone. Two passes over the bytes; no line is
shuffled. Both passes must see the same splits, so they run in a session whose split size is fixed,
whatever executors come and go; a split that was not counted is an error, never a guess.

Quotes follow RFC 4180: a field with a quote in it is quoted, and its quotes are doubled. A last
record whose quotes are not closed ends with its file. A header must stand on one line.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import pinned_session, settled

WHOLE, HEAD, TAIL = 0, 1, 2
_PIECES = "path string, start bigint, kind int, first boolean, text string"
_ARROW_PIECES = pa.schema([("path", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])


def fixed_splits(spark: SparkSession) -> SparkSession:
    """A session in which a file is always cut at the same bytes."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return pinned_session(spark, **{"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": size})


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")
    )


def splits(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, start, odd, header`` of every split with lines: whether it begins inside quotes, and its file's first line.

    One row a split, written out, since both its rows and the headers are needed.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    rows = _lines(spark, paths).withColumn("row", F.monotonically_increasing_id())
    counted = rows.groupBy("path", "start").agg((F.sum(quotes) % 2).alias("parity"), F.min_by("line", "row").alias("line"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1
    head = F.first(F.when(F.col("start") == 0, F.regexp_replace("line", "^﻿", ""))).over(Window.partitionBy("path").orderBy("start"))
    return settled(spark, counted.select("path", "start", odd.alias("odd"), head.alias("header")), "splits")


class _Split:
    """The lines of one split, put together as they come."""

    def __init__(self, path: str, start: int, odd: bool):
        self.path, self.start, self.inside = path, start, odd
        self.kind = HEAD if odd else WHOLE
        self.first = start == 0 and not odd
        self.held: list[str] = []
        self.rows: list[tuple[int, bool, str]] = []

    def take(self, line: str, odd: bool) -> None:
        self.held.append(line)
        self.inside ^= odd
        if not self.inside:
            self.rows.append((self.kind, self.first, "\n".join(self.held)))
            self.held, self.kind, self.first = [], WHOLE, False

    def end(self) -> None:
        if self.held:  # a head here means that the whole split lies inside one field
            self.rows.append((TAIL if self.kind == WHOLE else HEAD, self.first, "\n".join(self.held)))

    def batch(self) -> pa.RecordBatch:
        kinds, firsts, texts = zip(*self.rows)
        n = len(self.rows)
        self.rows = []
        columns = [[self.path] * n, [self.start] * n, kinds, firsts, texts]
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ARROW_PIECES)], schema=_ARROW_PIECES)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Split | None = None
    for batch in batches:
        path, start, line, begins_odd = (batch.column(k) for k in range(4))
        odd = pc.equal(pc.bit_wise_and(pc.count_substring(line, '"'), 1), 1).to_pylist()
        for p, s, text, begins, o in zip(path.to_pylist(), start.to_pylist(), line.to_pylist(), begins_odd.to_pylist(), odd):
            if now is None or (p, s) != (now.path, now.start):
                if now is not None:
                    now.end()
                    if now.rows:
                        yield now.batch()
                now = _Split(p, s, begins)
            now.take(text, o)
        if now is not None and now.rows:
            yield now.batch()
    if now is not None:
        now.end()
        if now.rows:
            yield now.batch()


def quoted_records(spark: SparkSession, paths: Sequence[str], known: DataFrame) -> DataFrame:
    """``path, first, text`` of every record; ``known`` are the files' ``splits``."""
    # one row of two names a split (128 MB of text), so it is broadcast; lines must stay in their order
    begun = _lines(spark, paths).join(F.broadcast(known.select("path", "start", "odd")), ["path", "start"], "left")
    counted = F.coalesce("odd", F.raise_error(F.lit("a split of the second pass was not counted in the first")).cast("boolean"))
    pieces = begun.select("path", "start", "line", counted.alias("odd")).mapInArrow(_put_together, _PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select("path", "first", "text")
    cut = pieces.where(F.col("kind") != WHOLE)  # two a split at most
    return whole.unionByName(cut.groupBy("path").applyInArrow(_joined, "path string, first boolean, text string"))


def _joined(cut: pa.Table) -> pa.Table:
    """The records of one file that lie in several splits: each begins with a split's last piece."""
    rows = sorted(zip(*(cut.column(c).to_pylist() for c in ("start", "kind", "first", "text"))))
    records: list[list] = []
    for _, kind, first, text in rows:
        if kind == TAIL or not records:
            records.append([first, [text]])
        else:
            records[-1][1].append(text)
    paths = [cut.column("path")[0].as_py()] * len(records)
    texts = ["\n".join(parts) for _, parts in records]
    return pa.table({"path": pa.array(paths, pa.string()), "first": pa.array([f for f, _ in records], pa.bool_()), "text": pa.array(texts, pa.string())})


_RECORDS_AT_ONCE = 10_000
_ARROW_RECORDS = pa.schema([("path", pa.string()), ("first", pa.bool_()), ("text", pa.string())])


def payload_records(payloads: DataFrame) -> DataFrame:
    """``path, first, text`` of every record of CSV texts (``path, payload``), breaks inside quotes kept.

    A text is gone through once and its records leave in batches. Null and empty texts have none; a
    last record whose quotes are not closed ends with its text.
    """
    return payloads.select("path", "payload").mapInArrow(_payload_records, "path string, first boolean, text string")


def _payload_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts, first = [], True
            for text in _records_of(payload or ""):
                texts.append(text)
                if len(texts) == _RECORDS_AT_ONCE:
                    yield _record_batch(path, first, texts)
                    texts, first = [], False
            if texts:
                yield _record_batch(path, first, texts)


def _records_of(payload: str) -> Iterator[str]:
    held, inside = [], False
    for line in io.StringIO(payload, newline="\n"):
        held.append(line)
        inside ^= line.count('"') % 2 == 1
        if not inside:
            yield "".join(held).rstrip("\r\n")
            held = []
    if held:
        yield "".join(held).rstrip("\r\n")


def _record_batch(path: str, first: bool, texts: list[str]) -> pa.RecordBatch:
    columns = [[path] * len(texts), [first and k == 0 for k in range(len(texts))], texts]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ARROW_RECORDS)], schema=_ARROW_RECORDS)
