"""Joins of ingestion: receive metadata, and membership in extraction windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import in_range


def attach_metadata(messages: DataFrame, metadata: DataFrame, on: str | Sequence[str] | None = None) -> DataFrame:
    """Put a receive call's metadata on each of its messages.

    Without keys the metadata is one row, taken as a scalar subquery (Spark raises if
    there are more). With keys it is an ordinary join whose strategy Spark chooses by
    size; a receive call holds few messages, so no key is hot.
    """
    if on is not None:
        return messages.join(metadata, on, "left")
    row = metadata.select(F.struct(*metadata.columns).alias("row")).scalar()
    return messages.withColumn("__meta", row).select(*messages.columns, "__meta.*")


def in_windows(df: DataFrame, column: str, windows: DataFrame) -> DataFrame:
    """Rows with the window ``[start, stop)`` they fall in, once per window.

    A range condition alone would compare all rows with all windows. Each window is
    listed under the days it touches and the join is on the day, with the range as a
    further condition. No side is forced to be broadcast: Spark measures the windows,
    and a day that holds much of the data is split by the adaptive skew join. The
    windows' outer bounds are a filter too, which lets the scan skip the other days.
    """
    per_day = windows.withColumn(
        "__day",
        F.explode(F.sequence(F.to_date("start"), F.to_date(F.col("stop") - F.expr("INTERVAL '0.000001' SECOND")))),
    )
    moment = F.col(column)
    first, last = windows.agg(F.min("start")).scalar(), windows.agg(F.max("stop")).scalar()
    return (
        df.where((moment >= first) & (moment < last))
        .withColumn("__day", F.to_date(moment))
        .join(per_day, "__day")
        .where((moment >= F.col("start")) & (moment < F.col("stop")))
        .drop("__day")
    )


def in_windows_union(df: DataFrame, column: str, windows: DataFrame) -> DataFrame:
    """Rows in any of the windows, when these join up: one covering filter, no join.

    The ends are one driver row. Windows with gaps or overlaps raise.
    """
    ends = windows.agg(
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        F.sum(F.timestamp_diff("MICROSECOND", F.col("start"), F.col("stop"))).alias("covered"),
    ).first()
    if ends.start is None:
        return df.limit(0)
    span = ends.stop - ends.start
    if ends.covered != (span.days * 86_400 + span.seconds) * 1_000_000 + span.microseconds:
        raise ValueError("the windows leave gaps or overlap")
    return in_range(df, column, ends.start, ends.stop)
