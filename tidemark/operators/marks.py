"""High-water marks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import PATTERNS


def mark_column(df: DataFrame, column: str, pattern: str | None = None) -> Column:
    """The column a mark is taken over: itself, or its text parsed by a pattern name."""
    if pattern is None:
        return F.col(column)
    return F.try_to_timestamp(F.col(column), F.lit(PATTERNS[pattern])).cast("timestamp_ntz")


def high_water_mark(
    df: DataFrame,
    column: str,
    as_of: datetime | None = None,
    pattern: str | None = None,
    at_least: datetime | None = None,
) -> DataFrame:
    """One row ``mark``: the largest value that is not in the future.

    ``as_of`` replaces the clock. The guard stands in a filter, so the scan can skip
    what lies ahead; the maximum is combined on the map side. ``at_least`` looks only at
    values from there on: given an earlier mark, the scan skips nearly all row groups.
    """
    value = mark_column(df, column, pattern)
    kind = df.select(value.alias("v")).schema["v"].dataType.simpleString()
    now = _bound(as_of, kind) if as_of else F.current_timestamp().cast(kind)
    near = df.where(value <= now)
    if at_least is not None:
        near = near.where(value >= _bound(at_least, kind))
    return near.agg(F.max(value).alias("mark"))


def _bound(moment: datetime, kind: str) -> Column:
    return F.lit(str(moment)).cast(kind)


def last_mark(
    df: DataFrame,
    column: str,
    as_of: datetime | None = None,
    pattern: str | None = None,
    known: datetime | None = None,
):
    """The mark as a driver value (one cell), or None where there is none yet.

    ``known`` is an earlier mark, if one was kept. It only saves work: where no value
    reaches it (the table was replaced, or the run is for an earlier day) all are read.
    """
    if known is not None:
        mark = high_water_mark(df, column, as_of, pattern, known).first().mark
        if mark is not None:
            return mark
    return high_water_mark(df, column, as_of, pattern).first().mark
