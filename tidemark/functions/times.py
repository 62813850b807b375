"""Times as text, zones, and the difference between zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time patterns the feeds write and read.
PATTERNS = {
    "iso_millis": "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "iso_micros": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "iso_minute": "yyyy-MM-dd'T'HH:mm",
    "day_first": "dd-MM-yyyy HH:mm:ss",
    "seconds": "yyyy-MM-dd HH:mm:ss",
    "date": "yyyy-MM-dd",
    "date_day_first": "dd-MM-yyyy",
    "date_compact": "yyyyMMdd",
}


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def format_time(value: Column | str, pattern: str) -> Column:
    """A time as text, by pattern name."""
    return F.date_format(_column(value), PATTERNS[pattern])


def parse_time(value: Column | str, pattern: str) -> Column:
    """Text as a zone-free time, by pattern name; null where it does not fit."""
    return F.try_to_timestamp(_column(value), F.lit(PATTERNS[pattern])).cast("timestamp_ntz")


def parse_date(value: Column | str, pattern: str) -> Column:
    """Text as a date, by pattern name; null where it does not fit."""
    return F.try_to_date(_column(value), PATTERNS[pattern])


def parse_seconds(value: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with any fraction cut off."""
    return parse_time(F.split_part(_column(value), F.lit("."), F.lit(1)), "seconds")


def convert_zone(value: Column | str, source: str, target: str) -> Column:
    """Wall time in the target zone for a wall time in the source zone."""
    return F.convert_timezone(F.lit(source), F.lit(target), _column(value).cast("timestamp_ntz"))


def zone_offset_hours(utc: Column | str, source: str, target: str) -> Column:
    """Whole hours the target zone is ahead of the source zone at a UTC wall time."""
    ahead = F.timestamp_diff("SECOND", convert_zone(utc, "UTC", source), convert_zone(utc, "UTC", target))
    return (ahead / 3600).cast("int")
