"""Document-store exports: plain documents and documents with typed field values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payload import all_string_schema
from ..functions.text import first_filled, last_part

# The value kinds of a typed field that are kept, in order of preference.
VALUE_KINDS = ("stringValue", "integerValue", "doubleValue")

FIELD_MAP = T.MapType(
    T.StringType(), T.StructType([T.StructField(kind, T.StringType()) for kind in VALUE_KINDS])
)
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField(
            "document",
            T.StructType([T.StructField("name", T.StringType()), T.StructField("fields", FIELD_MAP)]),
        )
    ]
)


class NoDocuments(ValueError):
    """An extract that must hold documents is empty."""


def plain_documents(spark: SparkSession, path: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Flat documents, one JSON object a line, every field text (nested values as JSON).

    Name the fields for large folders. Without names they are the union of all
    documents' keys, found by one more pass; that pass raises on an empty extract.
    """
    if fields is None:
        fields = spark.read.json(path, primitivesAsString=True).columns
        if not fields:
            raise NoDocuments(f"no documents under {path}")
    return spark.read.schema(all_string_schema(fields)).json(path)


def require_documents(df: DataFrame) -> DataFrame:
    """Raise on an empty extract; looks at one row only."""
    if df.isEmpty():
        raise NoDocuments("the query returned no documents")
    return df


def document_id(name: Column | str) -> Column:
    """Last segment of a document's resource name."""
    return last_part(name)


def typed_documents(
    df: DataFrame, fields: Sequence[str], text: str = "value", id_column: str | None = None
) -> DataFrame:
    """Decode typed documents held as JSON text into one text column per field.

    A field is its string value, else its integer value, else its double value; other
    kinds are null. Empty text counts as missing. Results without a document are
    dropped. Columns of ``df`` other than the text are kept.
    """
    parsed = F.from_json(F.col(text), DOCUMENT_SCHEMA)["document"]
    # a generator drops the rows without a document; a filter would parse the text again
    found = df.withColumn("__doc", F.explode(F.filter(F.array(parsed), lambda document: document.isNotNull())))
    values = F.transform_values(
        F.col("__doc.fields"),
        lambda _, v: F.coalesce(
            first_filled(v[VALUE_KINDS[0]], v[VALUE_KINDS[1]]), v[VALUE_KINDS[2]]
        ),
    )
    decoded = found.withColumn("__values", values)
    columns = [F.try_element_at(F.col("__values"), F.lit(name)).alias(name) for name in fields]
    if id_column:
        columns.append(document_id("__doc.name").alias(id_column))
    return decoded.select(*(c for c in df.columns if c != text), *columns)


def field_names(df: DataFrame, text: str = "value") -> list[str]:
    """All field names of the typed documents, sorted (the set of keys, not the rows)."""
    fields = F.from_json(F.col(text), DOCUMENT_SCHEMA)["document"]["fields"]
    names = df.select(F.explode(F.map_keys(fields)).alias("name")).distinct()
    return sorted(row.name for row in names.collect())
