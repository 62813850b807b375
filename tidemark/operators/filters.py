"""Incremental and range predicates.

Bounds are typed literals of the column's own type, so that the comparison needs no
cast on the column and reaches the Parquet or JDBC scan.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import PATTERNS


def typed_literal(df: DataFrame, column: str, value: object) -> Column:
    """A value as a literal of the column's type (times by their wall-clock text)."""
    kind = df.schema[column].dataType.simpleString()
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast(kind)


def newer_than(df: DataFrame, column: str, mark: object | None) -> DataFrame:
    """Rows strictly above the high-water mark; all rows on a first run (no mark)."""
    return df if mark is None else df.where(F.col(column) > typed_literal(df, column, mark))


def matching(df: DataFrame, condition: str | None) -> DataFrame:
    """Rows under a configured SQL condition; all rows where none is configured."""
    return df.where(F.expr(condition)) if condition else df


def in_range(df: DataFrame, column: str, start: object, stop: object) -> DataFrame:
    """Rows in the half-open range [start, stop)."""
    low, high = typed_literal(df, column, start), typed_literal(df, column, stop)
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def on_days(df: DataFrame, column: str, first: date, stop: date) -> DataFrame:
    """Rows whose date lies in [first, stop).

    Equal to comparing ``CAST(column AS DATE)``, written on the bare column so that
    row groups outside the days are skipped.
    """
    return in_range(df, column, _midnight(first), _midnight(stop))


def _midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)


def text_time_between(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    """Rows whose ``dd-MM-yyyy HH:mm:ss`` text lies in [start, end], compared as times."""
    parsed = F.try_to_timestamp(F.col(column), F.lit(PATTERNS["day_first"])).cast("timestamp_ntz")
    return df.where(parsed.between(_wall(start), _wall(end)))


def instant_between(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows whose ISO-8601 text (with offset) is an instant in [start, end].

    The bounds are ISO texts too; offsets may differ on both sides.
    """
    instant = F.expr(f"try_cast(`{column}` AS timestamp)")
    return df.where(instant.between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def _wall(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
