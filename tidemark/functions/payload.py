"""JSON payloads: check, normalise, parse with a declared schema, flatten."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Envelope columns a bronze message table keeps beside the body.
ENVELOPE_COLUMNS = ("HTTPHeaders", "RetryAttempts", "MessageId", "RequestId")


def is_valid_json(body: Column | str) -> Column:
    """True where the text is exactly one JSON value.

    Spark's JSON functions stop after the first value, so ``{"a":1} x`` would pass
    them. The text is therefore read once as the only element of an array and once
    as an object's value: only a single complete value fits both frames. The second
    reading is strict, so single quotes and raw line breaks inside strings are refused.
    Repeated keys are allowed. Null, like empty text, is not JSON.
    """
    text = F.col(body) if isinstance(body, str) else body
    as_element = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    strict = {"allowSingleQuotes": "false", "allowUnquotedControlChars": "false"}
    as_value = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "map<string,string>", strict)
    return F.coalesce((as_element == 1) & as_value.isNotNull(), F.lit(False))


def with_validity(df: DataFrame, flag: str = "accepted", body: str = "Body") -> DataFrame:
    """Mark each row by whether its body is JSON; one pass serves both kinds."""
    return df.withColumn(flag, is_valid_json(body))


def split_valid(df: DataFrame, body: str = "Body") -> tuple[DataFrame, DataFrame]:
    """Rows whose body is JSON, and the rows set aside, as two frames (so, two passes)."""
    ok = is_valid_json(body)
    return df.where(ok), df.where(~ok)


def normalize_json(body: Column | str) -> Column:
    """Parse and write JSON again: no padding, object keys in order, ``1.50`` as ``1.5``.

    The text ``null`` and objects with repeated keys have no variant form; they keep
    their own text.
    """
    text = F.col(body) if isinstance(body, str) else body
    return F.coalesce(F.to_json(F.try_parse_json(text)), F.trim(text))


def struct_to_json(*columns: Column | str, keep_nulls: bool = True) -> Column:
    """Several columns as one JSON object."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": str(not keep_nulls).lower()})


def all_string_schema(fields: Iterable[str]) -> T.StructType:
    """Declared body schema: every field nullable text; nested values stay JSON text."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in fields])


def parse_body(df: DataFrame, schema: T.StructType, body: str = "Body") -> DataFrame:
    """Replace the JSON text column by a struct of the declared fields."""
    return df.withColumn(body, F.from_json(F.col(body), schema))


def flatten_body(
    df: DataFrame,
    schema: T.StructType,
    body: str = "Body",
    envelope: Sequence[str] = ENVELOPE_COLUMNS,
) -> DataFrame:
    """Body fields in declared order, then the envelope columns."""
    return parse_body(df, schema, body).select(f"{body}.*", *envelope)


def stringify_all(df: DataFrame) -> DataFrame:
    """Every column as text; null stays null."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
