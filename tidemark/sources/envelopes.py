"""Values inside XML response envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Response element below the envelope's body, by kind of call.
RESPONSES = {
    "report_id": "runReportResponse",
    "is_running": "isReportRunningResponse",
    "result_csv": "getReportResultCsvResponse",
}


ROOT = "Envelope"


def response_schema(kind: str) -> str:
    """Columns of an envelope that lead to the return value of a kind of call."""
    if kind not in RESPONSES:
        raise ValueError(f"unknown response kind {kind!r}")
    return f"Body struct<{RESPONSES[kind]}: struct<`return`: string>>"


def xml_value(envelope: Column | str, kind: str, required: bool = True) -> Column:
    """Return value of a response; a missing element raises, or is null if not required.

    Prefixes do not matter, only local names. The text is streamed through once (an
    XPath would build a tree per row) and comes back whole, blanks included.
    """
    xml = F.col(envelope) if isinstance(envelope, str) else envelope
    options = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "nullValue": "\u0000"}
    reply = F.from_xml(xml, response_schema(kind), options)
    has_root = F.rlike(xml, F.lit(rf"<([^\s<>:/]+:)?{ROOT}[\s>]"))
    value = F.when(has_root, reply["Body"][RESPONSES[kind]]["return"])
    return F.coalesce(value, F.raise_error(F.lit(f"response holds no {kind}")).cast("string")) if required else value


def payload_lines(df: DataFrame, payload: str) -> DataFrame:
    """A CSV payload column as one row per text line, with its line number; other columns kept."""
    rest = [c for c in df.columns if c != payload]
    return df.select(*rest, F.posexplode(F.split(F.col(payload), "\r?\n")).alias("line_no", "line"))
