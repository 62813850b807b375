"""Small text expressions shared by the feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def iso_prefix(value: Column | str) -> Column:
    """An ISO-8601 time cut to whole seconds, without its zone."""
    return F.substring(_column(value), 1, 19)


def part_before(value: Column | str, separator: str) -> Column:
    """Text before the first separator; all of it where there is none."""
    return F.split_part(_column(value), F.lit(separator), F.lit(1))


def part_after(value: Column | str, separator: str) -> Column:
    """Text between the first and the second separator."""
    return F.split_part(_column(value), F.lit(separator), F.lit(2))


def last_part(value: Column | str, separator: str = "/") -> Column:
    """Text after the last separator: a document id, a queue's table, a file name."""
    return F.split_part(_column(value), F.lit(separator), F.lit(-1))


def replace_text(value: Column | str, old: str, new: str = "") -> Column:
    return F.replace(_column(value), F.lit(old), F.lit(new))


def capitalize(value: Column | str) -> Column:
    """First letter upper case, all others lower case (one word or many)."""
    text = _column(value)
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2147483647)))


def first_filled(*values: Column | str) -> Column:
    """First alternative that is neither null nor empty text."""
    return F.coalesce(*(F.nullif(_column(v), F.lit("")) for v in values))
