"""Marks of text columns, kept with a table and carried on by its loads.

A lookup that had to read the table keeps what it found; from then on every load of files
(``copy_into``) measures its own rows during their write, and later lookups read no row. A value
ahead of the time asked for does not spoil a mark: the values next to it on both sides are kept.
Where what is kept cannot answer, the table is read. What is kept holds for one value of the
table's ``written`` note, which all writers of this library change; another one has to call ``touch``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import PATTERNS
from .tables import WRITTEN, quoted, set_table_note, table_notes

Moment = datetime | None
CARRIED = "text_mark."


@dataclass(frozen=True)
class KeptMark:
    """No value lies between ``near`` and ``next``; ``last`` is the greatest of all."""

    near: Moment
    next: Moment
    last: Moment

    def around(self, moment: datetime) -> KeptMark | None:
        """The same with ``moment`` between ``near`` and ``next``; None where that cannot be known."""
        if self.last is None or self.last <= moment:
            return KeptMark(self.last, None, self.last)
        if (self.near is None or self.near <= moment) and self.next is not None and moment < self.next:
            return self
        return None

    def with_rows(self, rows: KeptMark, moment: datetime) -> KeptMark | None:
        """After rows were added whose own state is around ``moment``."""
        mine = self.around(moment)
        if mine is None:
            return None
        pick = lambda choose, *values: choose((v for v in values if v is not None), default=None)
        return KeptMark(pick(max, mine.near, rows.near), pick(min, mine.next, rows.next), pick(max, mine.last, rows.last))

    def values(self) -> list[str | None]:
        return [v.isoformat() if v else None for v in (self.near, self.next, self.last)]

    @classmethod
    def parse(cls, values: list[str | None]) -> KeptMark:
        return cls(*(datetime.fromisoformat(v) if v else None for v in values))


def _key(column: str, pattern: str | None) -> str:
    return f"{CARRIED}{column}|{pattern or ''}"


def _measures(column: str, pattern: str | None, moment: datetime) -> list[Column]:
    """Aggregates ``near, next, last`` over a text column, as text."""
    text = F.col("`" + column.replace("`", "``") + "`").cast("string")
    if pattern is None:
        value = text.try_cast("timestamp_ntz")
    else:
        value = F.try_to_timestamp(text, F.lit(PATTERNS[pattern])).cast("timestamp_ntz")
    pivot = F.lit(str(moment)).cast("timestamp_ntz")
    found = (F.max(F.when(value <= pivot, value)), F.min(F.when(value > pivot, value)), F.max(value))
    return [c.cast("string").alias(f"{column}|{pattern or ''}|{n}") for n, c in enumerate(found)]


def kept(spark: SparkSession, name: str) -> dict[str, KeptMark]:
    """Kept marks of a table that hold for its rows as they are, by the keys of their notes."""
    return _holding(table_notes(spark, name))


def _holding(notes: dict[str, str]) -> dict[str, KeptMark]:
    found = {}
    for key, note in notes.items():
        if key.startswith(CARRIED):
            written, values = json.loads(note)
            if written == notes.get(WRITTEN):
                found[key] = KeptMark.parse(values)
    return found


def _keep(spark: SparkSession, name: str, key: str, state: KeptMark, written: str) -> None:
    set_table_note(spark, name, key, json.dumps([written, state.values()]))


def text_mark(spark: SparkSession, name: str, column: str, pattern: str | None, as_of: datetime) -> Moment:
    """Greatest time in a text column that is not after ``as_of``; reads the table only where nothing kept tells it."""
    key, notes = _key(column, pattern), table_notes(spark, name)
    state = _holding(notes).get(key)
    state = state and state.around(as_of)
    if state is None:
        written = notes.get(WRITTEN)
        if not written:
            written = uuid.uuid4().hex
            set_table_note(spark, name, WRITTEN, written)
        state = KeptMark.parse(list(spark.table(quoted(name)).agg(*_measures(column, pattern, as_of)).first()))
        _keep(spark, name, key, state, written)  # a write meanwhile has made it void
    return state.near


class Carried:
    """The marks a table keeps, taken before a load writes and kept again with its rows added."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        there = spark.catalog.tableExists(quoted(name))
        self.kept = kept(spark, name) if there else {}
        self.moment = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz")).first()[0] if self.kept else None

    def measures(self, rows: DataFrame) -> list[Column]:
        """What to observe while ``rows`` are written."""
        here, found = {c.lower() for c in rows.columns}, []
        for key in self.kept:
            column, _, pattern = key.removeprefix(CARRIED).rpartition("|")
            if column.lower() in here:
                found += _measures(column, pattern or None, self.moment)
        return found

    def keep(self, seen: dict[str, str | None]) -> None:
        """After the write. A load that breaks before it leaves no mark, so the next lookup reads the table."""
        written = table_notes(self.spark, self.name).get(WRITTEN) if self.kept else None
        for key, state in self.kept.items():
            try:
                added = KeptMark.parse([seen.get(f"{key.removeprefix(CARRIED)}|{n}") for n in range(3)])
            except ValueError:  # a time Python cannot hold
                continue
            after = state.with_rows(added, self.moment)
            if after is not None:
                _keep(self.spark, self.name, key, after, written)
