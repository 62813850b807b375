"""Column-name hygiene."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

# Characters a table column may not carry.
ILLEGAL_CHARACTERS = " ,;{}()\n\t="

_RUN = re.compile(f"[{re.escape(ILLEGAL_CHARACTERS)}_]+")


class IllegalColumnName(ValueError):
    """A column name the table format cannot hold."""


class ColumnNameCollision(ValueError):
    """Two columns would end up with one name."""


def clean_name(name: str) -> str:
    """Illegal characters become underscores; runs collapse and the edges are trimmed."""
    return _RUN.sub("_", name).strip("_")


def _rename_all(df: DataFrame, names: list[str]) -> DataFrame:
    repeated = sorted(n for n, k in Counter(n.lower() for n in names).items() if k > 1)
    if repeated:
        raise ColumnNameCollision(f"columns would share a name: {', '.join(repeated)}")
    return df.toDF(*names)


def clean_column_names(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Clean every column name; those in ``keep`` (say, audit columns) stay as they are."""
    kept = set(keep)
    return _rename_all(df, [c if c in kept else clean_name(c) for c in df.columns])


def underscore_spaces(df: DataFrame) -> DataFrame:
    """Header rule of the delimited feeds: a space becomes an underscore."""
    return _rename_all(df, [c.replace(" ", "_") for c in df.columns])


def assert_legal_names(df: DataFrame) -> DataFrame:
    """Return ``df`` unchanged, or raise on the first illegal column name."""
    for name in df.columns:
        if any(ch in name for ch in ILLEGAL_CHARACTERS):
            raise IllegalColumnName(f"column {name!r} holds an illegal character")
    return df


def harmonize_columns(df: DataFrame, variants: Mapping[str, str]) -> DataFrame:
    """Rename known spellings to the agreed one; absent spellings are ignored."""
    return df.withColumnsRenamed({old: new for old, new in variants.items() if old in df.columns})
