"""Extraction windows: which stretch of time a run has to load.

Windows come as frames ``start, stop`` (half-open) made by ``sequence``; marks may be
driver values or come from a frame, one row per mark.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICES_PER_DAY = (1, 2, 3)


def wall_time(value: datetime | date | Column) -> Column:
    """A zone-free time column from a driver value; columns pass through."""
    if isinstance(value, Column):
        return value
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select()


def subday_slices(df: DataFrame, start: Column, end: Column, per_day: int) -> DataFrame:
    """Each row's [start, end) cut into 24, 12 or 8 hour slices; the last one is clipped."""
    if per_day not in SLICES_PER_DAY:
        raise ValueError(f"slices per day must be one of {SLICES_PER_DAY}, not {per_day}")
    step = F.expr(f"INTERVAL '{24 // per_day}' HOUR")
    starts = F.when(start < end, F.sequence(start, end, step))
    begun = df.withColumns({"__end": end, "__starts": starts}).withColumn("start", F.explode("__starts"))
    return (
        begun.where(F.col("start") < F.col("__end"))
        .withColumn("stop", F.least(F.col("start") + step, F.col("__end")))
        .drop("__end", "__starts")
    )


def whole_days(df: DataFrame, mark: Column, as_of: date) -> DataFrame:
    """One window a day from the day after the mark to yesterday; none when up to date."""
    first = F.date_add(F.to_date(mark), 1)
    last = F.date_sub(F.lit(as_of), 1)
    days = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL '1' DAY")))
    day = df.withColumn("__day", F.explode(days))
    return day.withColumns(
        {"start": F.col("__day").cast("timestamp_ntz"), "stop": F.date_add("__day", 1).cast("timestamp_ntz")}
    ).drop("__day")


def yesterday(as_of: date) -> tuple[datetime, datetime]:
    """[midnight yesterday, midnight today)."""
    today = datetime(as_of.year, as_of.month, as_of.day)
    return today - timedelta(days=1), today


def lookback_start(mark: Column, days: int) -> Column:
    """Midnight ``days - 1`` days before the mark, so that recent days load again."""
    return F.date_trunc("DAY", mark).cast("timestamp_ntz") - F.expr(f"INTERVAL '{days - 1}' DAY")


def days_since(mark: datetime, as_of: datetime) -> int:
    """Days back from now that reach the files dated strictly after the mark's day."""
    return (as_of.date() - mark.date()).days - 1


@dataclass(frozen=True)
class WindowRule:
    """How a feed chooses its window.

    ``frequency`` is ``hourly``, ``daily`` or ``manual``; daily feeds look ``days``
    back and cut each day into ``per_day`` slices, or take whole days after the mark.
    """

    frequency: str
    days: int = 1
    per_day: int = 1
    whole_days: bool = False
    start: datetime | None = None
    stop: datetime | None = None


def window_for(spark: SparkSession, rule: WindowRule, mark: datetime | None, as_of: datetime) -> DataFrame:
    """The windows ``start, stop`` one run has to extract."""
    base = one_row(spark)
    if rule.frequency == "manual":
        if rule.start is None or rule.stop is None:
            raise ValueError("a manual run names its start and stop")
        return base.select(wall_time(rule.start).alias("start"), wall_time(rule.stop).alias("stop"))
    if mark is None:
        raise ValueError("an incremental window needs a mark; load the first run with a manual window")
    if rule.frequency == "hourly":
        return base.select(wall_time(mark).alias("start"), wall_time(as_of).alias("stop"))
    if rule.frequency == "daily":
        if rule.whole_days:
            return whole_days(base, wall_time(mark), as_of.date())
        start = lookback_start(wall_time(mark), rule.days)
        return subday_slices(base, start, wall_time(as_of), rule.per_day)
    raise ValueError(f"unknown frequency {rule.frequency!r}")
