"""Audit columns: who delivered a batch, when, and how many rows it had."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of audit columns.
ROW_COUNT = "_qtd_rows"
FIXED_ROW_COUNT = "_qt_rows"


def with_literals(df: DataFrame, literals: Mapping[str, object]) -> DataFrame:
    """Add constant columns in the mapping's order, in one projection."""
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})


def with_row_count(df: DataFrame, name: str = ROW_COUNT) -> DataFrame:
    """Put the batch's row count on every row.

    A scalar subquery: counted on the executors with partial counts, so neither a
    driver round trip nor a one-task window. ``df`` is planned twice; give it a
    written batch (``shared.settled``), where the count only reads file footers.
    """
    return df.withColumn(name, df.agg(F.count(F.lit(1))).scalar())


def with_audit(df: DataFrame, literals: Mapping[str, object], count_column: str = ROW_COUNT) -> DataFrame:
    """Any audit literals plus the row count."""
    count = df.agg(F.count(F.lit(1))).scalar()
    return with_literals(df, literals).withColumn(count_column, count)


def with_fixed_audit(
    df: DataFrame, data_source: str, source_type: str, cost_center: str, system_owner: str
) -> DataFrame:
    """The four standard audit literals plus the row count."""
    # Names of the four.
    return with_audit(
        df,
        {
            "_data_source": data_source,
            "_source_type": source_type,
            "_cost_center": cost_center,
            "_system_owner": system_owner,
        },
        FIXED_ROW_COUNT,
    )


def zone_offset_hours(at: datetime, source: str, target: str) -> int:
    """Whole hours the target zone is ahead of the source zone at one instant (driver value)."""
    instant = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    ahead = instant.astimezone(ZoneInfo(target)).utcoffset() - instant.astimezone(ZoneInfo(source)).utcoffset()
    return int(ahead.total_seconds() / 3600)


def extraction_literals(at: datetime, source: str, target: str) -> dict[str, object]:
    """Zone offset and target-zone wall time of an extract, ready for ``with_audit``."""
    instant = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return {
        "_timezone_diff": zone_offset_hours(instant, source, target),
        "_extraction_date": instant.astimezone(ZoneInfo(target)).strftime("%Y-%m-%d %H:%M:%S"),
    }
