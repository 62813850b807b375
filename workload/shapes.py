"""Projections, audit columns, names, payloads and scalar functions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import audit, names, payload, text, times

from .registry import query
from .staging import table


@query(
    """
    SELECT c_custkey, c_name, 'crm' AS _data_source, 'database' AS _source_type, 'sales' AS _cost_center,
           'ops' AS _system_owner, (SELECT count(*) FROM customer) AS _qt_rows
    FROM customer
    """
)
def audit_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return audit.with_fixed_audit(rows, "crm", "database", "sales", "ops")


@query(
    """
    SELECT o_orderkey, o_totalprice, 'erp' AS _data_source, 7 AS _cost_center,
           (SELECT count(*) FROM orders) AS _qtd_rows
    FROM orders
    """
)
def audit_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return audit.with_audit(rows, {"_data_source": "erp", "_cost_center": 7})


@query(
    """
    SELECT event_type, count(*) AS n_rows, max(batch) AS _qtd_rows
    FROM (SELECT event_type, (SELECT count(*) FROM events WHERE value > 1) AS batch FROM events WHERE value > 1) e
    GROUP BY event_type
    """
)
def audit_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = table(spark, sf_dir, "events").where("value > 1").select("event_type", "value")
    counted = audit.with_row_count(batch)
    return counted.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.max("_qtd_rows").alias("_qtd_rows"))


@query(
    """
    SELECT c_custkey, 4 AS _timezone_diff, '2024-07-01 09:00:00' AS _extraction_date,
           (SELECT count(*) FROM customer) AS _qtd_rows
    FROM customer
    """
)
def extraction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = datetime(2024, 7, 1, 12, 0, tzinfo=timezone.utc)
    literals = audit.extraction_literals(at, "US/Pacific", "America/Sao_Paulo")
    return audit.with_audit(table(spark, sf_dir, "customer").select("c_custkey"), literals)


@query(
    """
    SELECT CAST(json_extract(props, '$.k') AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS missing,
           CAST(event_id AS VARCHAR) AS MessageId, event_type AS RequestId
    FROM events
    """
)
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").select(
        F.col("props").alias("Body"), F.col("event_id").cast("string").alias("MessageId"),
        F.col("event_type").alias("RequestId"),
    )
    schema = payload.all_string_schema(["k", "missing"])
    return payload.flatten_body(messages, schema, envelope=["MessageId", "RequestId"])


def broken_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose payload is broken in several ways, by id."""
    case = F.col("event_id") % 10
    body = (
        F.when(case == 0, F.lit("not json"))
        .when(case == 1, F.concat("props", F.lit(" trailing")))
        .when(case == 2, F.lit(""))
        .when(case == 3, F.expr("substring(props, 1, length(props) - 1)"))
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select("event_id", "event_type", body.alias("Body"))


@query(
    """
    SELECT event_type, event_id % 10 >= 4 AS accepted, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum
    FROM events GROUP BY 1, 2
    """
)
def valid_json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = payload.with_validity(broken_bodies(spark, sf_dir))
    return marked.groupBy("event_type", "accepted").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query("SELECT event_id, '{\"k\":' || json_extract(props, '$.k') || ',\"t\":\"' || event_type || '\"}' AS body FROM events")
def json_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit('{ "t" : "'), "event_type", F.lit('",  "k": '), F.get_json_object("props", "$.k"), F.lit(" }"))
    rows = table(spark, sf_dir, "events").select("event_id", padded.alias("raw"))
    return rows.select("event_id", payload.normalize_json("raw").alias("body"))


@query(
    """
    SELECT o_orderkey, '{"key":' || o_orderkey || ',"status":"' || o_orderstatus || '","note":null}' AS body
    FROM orders
    """
)
def struct_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    body = payload.struct_to_json(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.lit(None).cast("string").alias("note")
    )
    return orders.select("o_orderkey", body.alias("body"))


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           nullif(o_orderstatus, 'P') AS status, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders
    """
)
def stringify_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.to_date("o_orderdate").alias("day")
    )
    return payload.stringify_all(orders)


@query("SELECT p_partkey AS part_key, p_name AS part_name, p_size AS size FROM part")
def normalize_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part key"), F.col("p_name").alias("part name"), F.col("p_size").alias("size")
    )
    return names.underscore_spaces(part)


@query(
    """
    SELECT p_partkey AS part_key, p_name AS name, p_brand AS brand_code, p_retailprice AS price_BRL, p_size AS _batch
    FROM part
    """
)
def clean_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part = key"), F.col("p_name").alias(" name;"), F.col("p_brand").alias("brand\t{code}"),
        F.col("p_retailprice").alias("price (BRL)"), F.col("p_size").alias("_batch"),
    )
    return names.assert_legal_names(names.clean_column_names(part, keep=["_batch"]))


@query('SELECT p_name AS "Package name", p_size AS size FROM part')
def harmonize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    old = part.where("p_size <= 10").select(F.col("p_name").alias("Package Name"), F.col("p_size").alias("size"))
    new = part.where("p_size > 10").select(F.col("p_name").alias("Package name"), F.col("p_size").alias("size"))
    variants = {"Package Name": "Package name"}
    return names.harmonize_columns(old, variants).unionByName(names.harmonize_columns(new, variants))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return orders.drop("o_orderdate")


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created FROM events")
def iso_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = times.format_time("ts", "iso_micros")
    return table(spark, sf_dir, "events").select(
        "event_id", text.iso_prefix(F.concat(iso, F.lit("-03:00"))).alias("created")
    )


@query(
    """
    SELECT page_id, split_part(url, '://', 1) AS scheme, split_part(url, '/', -1) AS last,
           split_part(split_part(url, '/', 3), '.', -1) AS top_domain, split_part(url, 'example.', 2) AS after_host
    FROM pages
    """
)
def split_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.split_part("url", F.lit("/"), F.lit(3))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.part_before("url", "://").alias("scheme"),
        text.last_part("url").alias("last"),
        text.last_part(host, ".").alias("top_domain"),
        text.part_after("url", "example.").alias("after_host"),
    )


@query("SELECT p_partkey, replace(p_name, ' ', '_') AS name, replace(p_brand, 'Brand#', '') AS brand FROM part")
def replace_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.replace_text("p_name", " ", "_").alias("name"), text.replace_text("p_brand", "Brand#").alias("brand")
    )


@query(
    """
    SELECT p_partkey, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS type,
           upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS name
    FROM part
    """
)
def capitalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.capitalize("p_type").alias("type"), text.capitalize("p_name").alias("name")
    )


@query(
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS iso_millis, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso_micros,
           strftime(ts, '%Y-%m-%dT%H:%M') AS iso_minute, strftime(ts, '%d-%m-%Y %H:%M:%S') AS day_first,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS seconds, strftime(ts, '%Y%m%d') AS date_compact
    FROM events
    """
)
def format_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ("iso_millis", "iso_micros", "iso_minute", "day_first", "seconds", "date_compact")
    return table(spark, sf_dir, "events").select(
        "event_id", *(times.format_time("ts", name).alias(name) for name in wanted)
    )


@query(
    """
    SELECT event_id, date_trunc('second', ts) AS day_first, CAST(CAST(ts AS DATE) AS VARCHAR) AS leading, CAST(CAST(ts AS DATE) AS VARCHAR) AS compact,
           CAST(NULL AS TIMESTAMP) AS unfit, date_trunc('second', ts) AS cut
    FROM events
    """
)
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = table(spark, sf_dir, "events").select(
        "event_id", times.format_time("ts", "day_first").alias("a"), times.format_time("ts", "date_day_first").alias("b"),
        times.format_time("ts", "date_compact").alias("c"), F.col("ts").cast("string").alias("d"),
    )
    return written.select(
        "event_id",
        times.parse_time("a", "day_first").alias("day_first"),
        times.parse_date("b", "date_day_first").cast("string").alias("leading"),
        times.parse_date("c", "date_compact").cast("string").alias("compact"),
        times.parse_time("c", "iso_minute").alias("unfit"),
        times.parse_seconds("d").alias("cut"),
    )


@query(
    """
    SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS local_ts,
           (ts AT TIME ZONE 'America/Sao_Paulo') AT TIME ZONE 'UTC' AS utc_ts
    FROM events
    """
)
def convert_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.convert_zone("ts", "UTC", "America/Sao_Paulo").alias("local_ts"),
        times.convert_zone("ts", "America/Sao_Paulo", "UTC").alias("utc_ts"),
    )


@query(
    """
    SELECT o_orderkey, CAST(date_diff('hour', (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific',
                                      (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo') AS INTEGER) AS hours
    FROM orders
    """
)
def zone_offset_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", times.zone_offset_hours("o_orderdate", "US/Pacific", "America/Sao_Paulo").alias("hours")
    )
