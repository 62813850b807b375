"""Whole feeds: a landing job and a bronze job over files made from the given tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import BronzeJob, LandingJob
from tidemark.functions.times import format_time
from tidemark.jobs import run_bronze, run_landing
from tidemark.operators import rows
from tidemark.shared import new_folder
from tidemark.sinks import tables

from .registry import query
from .scans import cast_to, trailing_files, typed_customers, zipped_events
from .staging import fresh_schema, staged, table

AS_OF = datetime(2024, 1, 20, 12, 0)
METADATA = {"data_source": "lake", "source_type": "files", "cost_center": "data", "system_owner": "ops"}


class Feed:
    """One table's landing and bronze jobs over folders of their own."""

    def __init__(self, spark: SparkSession, source: str, about: Mapping[str, object], bronze: Mapping[str, object] | None = None):
        self.spark = spark
        self.schema = fresh_schema()
        root = new_folder(spark, "feed")
        self.landing = {
            "catalog": "spark_catalog",
            "metadata": METADATA,
            "schemas": {self.schema: {"rows": dict(about)}},
            "outputs": f"{root}/landing/{{schema}}/{{table}}",
            "input": source,
        }
        file_format = about.get("file_format", "json")
        self.bronze = BronzeJob.from_json(
            {
                "input_path": self.landing["outputs"],
                "location": f"{root}/bronze/{{schema}}/{{table}}",
                "checkpoints": f"{root}/checkpoints/{{schema}}/{{table}}",
                "schemas": {self.schema: {"rows": {"mode": "append", "file_format": file_format, **(bronze or {})}}},
            }
        )

    def run(self, as_of: datetime = AS_OF, **changes: object) -> DataFrame:
        """Land what is new, load it, and give the bronze table."""
        if run_landing(self.spark, LandingJob.from_json({**self.landing, **changes}), as_of)[f"{self.schema}.rows"]:
            run_bronze(self.spark, self.bronze)
        return self.spark.table(f"{self.schema}.rows")


@query(
    """
    SELECT event_id, user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS file_date,
           CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-20'
                THEN (SELECT count(*) FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20')
                ELSE (SELECT count(*) FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-21' AND DATE '2024-01-25')
           END AS _qtd_rows
    FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-25'
    """
)
def feed_dated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; the second one takes only the files dated after the first one's mark."""
    source = trailing_files(spark, sf_dir)
    feed = Feed(spark, source, {"reader": "dated_files", "prefix": "visits_", "mark_column": "_file_generation_date"})
    first = datetime(2024, 1, 20, 12)
    # a first run has no mark and takes every file: give it those delivered by then
    days = "{{0[1-9],1[0-9],20}}"  # doubled braces, as the path is a template
    feed.run(first, input=f"{source}/daily_visits_202401{days}-*")
    return cast_to(
        feed.run(datetime(2024, 1, 25, 12)).withColumnRenamed("_file_generation_date", "file_date"),
        "event_id bigint, user_id bigint, event_type string, file_date string, _qtd_rows bigint",
    )


@query("SELECT event_id, event_type, value, '2024-01-15' AS file_date FROM events WHERE event_id % 3 <> 0")
def feed_zipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = Feed(
        spark, zipped_events(spark, sf_dir),
        {"reader": "zipped_files", "prefix": "events", "keyword": "reward", "mark_column": "_file_generation_date"},
    )
    feed.run()
    again = feed.run()  # nothing is newer than the mark
    return again.select(
        F.col("event_id").cast("bigint").alias("event_id"), "event_type", F.col("value").cast("double").alias("value"),
        F.to_date("_file_generation_date").cast("string").alias("file_date"),
    )


@query(
    """
    SELECT event_id AS Event_Id, count(*) AS times_loaded FROM (
      SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-19'
      UNION ALL
      SELECT event_id FROM events
      WHERE ts >= (SELECT date_trunc('day', max(date_trunc('second', ts))) - INTERVAL 1 DAY FROM events WHERE ts < TIMESTAMP '2024-01-19')
        AND ts < TIMESTAMP '2024-01-20 12:00:00') loads
    GROUP BY event_id
    """
)
def feed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manual load, then a daily run that looks two days back and appends those again."""
    report = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Event Id"), format_time("ts", "iso_micros").alias("Started At"), "event_type"
    )
    source = staged(
        spark, sf_dir, "events-report", lambda f: report.write.options(header=True, escape='"').csv(f)
    )
    feed = Feed(
        spark, source,
        {
            "reader": "reports", "time_column": "Started_At", "mark_column": "Started_At", "file_format": "parquet",
            "daily_extract": {"days": 2}, "time_intervals": 3, "multi_line": False,
            "start_date": "2024-01-10T00:00:00", "end_date": "2024-01-19T00:00:00", "zones": ["UTC", "America/Sao_Paulo"],
        },
    )
    feed.run(incremental=False)
    loaded = feed.run(frequency="daily").groupBy(F.col("Event_Id").cast("bigint").alias("Event_Id"))
    return loaded.agg(F.count(F.lit(1)).alias("times_loaded"))


@query(
    """
    SELECT event_id AS Event_Id, event_type || chr(10) || '"' || event_id || '" & <more>, ' || chr(10) AS Note
    FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-19'
    """
)
def feed_wrapped_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports that landed as replies: XML envelopes around CSV with line breaks and quotes inside fields."""
    number = F.col("event_id").cast("string")
    note = F.concat("event_type", F.lit('\n""'), number, F.lit('"" &amp; &lt;more>, \n'))
    line = F.concat(number, F.lit(","), format_time("ts", "iso_micros"), F.lit(',"'), note, F.lit('"'))
    replies = table(spark, sf_dir, "events").groupBy(F.expr("event_id div 500")).agg(F.array_join(F.collect_list(line), "\n").alias("lines"))
    wrapped = replies.select(
        F.concat(
            F.lit('<e:Envelope xmlns:e="urn:e"><e:Body><r:getReportResultCsvResponse xmlns:r="urn:r"><return>Event Id,Started At,Note\n'),
            "lines", F.lit("</return></r:getReportResultCsvResponse></e:Body></e:Envelope>"),
        ).alias("value")
    )
    source = staged(spark, sf_dir, "events-replies", lambda f: wrapped.write.option("maxRecordsPerFile", 1).text(f))
    about = {
        "reader": "reports", "replies": True, "time_column": "Started_At", "mark_column": "Started_At", "file_format": "json",
        "start_date": "2024-01-10T00:00:00", "end_date": "2024-01-19T00:00:00",
    }
    loaded = Feed(spark, source, about).run(incremental=False)
    return loaded.select(F.col("Event_Id").cast("bigint").alias("Event_Id"), "Note")


@query(
    """
    SELECT DISTINCT user_id, event_type, date_trunc('second', ts) AS created FROM events
    WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20'
    """
)
def feed_plain_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"), "event_type", format_time("ts", "day_first").alias("createdAt"),
        F.col("event_id").cast("string").alias("dateOfCreation"),
    )
    source = staged(spark, sf_dir, "events-documents", lambda f: rows.union_by_position([documents, documents]).write.json(f))
    feed = Feed(
        spark, source,
        {
            "reader": "plain_documents", "mark_column": "createdAt", "mark_pattern": "day_first", "file_format": "csv",
            "fields": documents.columns, "drop": ["dateOfCreation"],
        },
    )
    created = F.try_to_timestamp("createdAt", F.lit("dd-MM-yyyy HH:mm:ss")).cast("timestamp_ntz")
    return feed.run().select(F.col("user_id").cast("bigint").alias("user_id"), "event_type", created.alias("created"))


@query(
    """
    SELECT c_custkey AS doc_key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
           'lake' AS _data_source, (SELECT count(*) FROM customer) AS _qtd_rows
    FROM customer
    """
)
def feed_typed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = Feed(
        spark, typed_customers(spark, sf_dir),
        {"reader": "typed_documents", "id_column": "doc_key", "file_format": "csv", "fields": ["name", "nation", "balance"]},
    )
    return cast_to(
        feed.run(), "doc_key bigint, name string, nation int, balance double, _data_source string, _qtd_rows bigint"
    )


@query(
    """
    SELECT o_orderkey AS Order_id, o_totalprice AS Amount, NULL AS Priority FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
    """
)
def feed_store_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with two layouts, republished whole: a second run leaves the same table."""

    def build(folder: str) -> None:
        orders = table(spark, sf_dir, "orders")
        old = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("Order Id"), F.col("o_totalprice").alias("Amount"))
        new = orders.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("Order id"), F.col("o_orderpriority").alias("Priority"))
        for part in (old, new):
            part.write.mode("append").options(header=True, encoding="UTF-16LE").csv(folder)

    feed = Feed(
        spark, staged(spark, sf_dir, "orders-reports", build),
        {"reader": "store_reports", "suffix": ".csv", "file_format": "csv", "variants": {"Order Id": "Order id"}},
        {"clean_names": True},
    )
    feed.run()
    return cast_to(feed.run(), "Order_id bigint, Amount double, Priority string")


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-11'
    """
)
def feed_warehouse_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manual year, then the whole days after it, all columns as text."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    source = staged(spark, sf_dir, "orders-view", lambda f: orders.write.parquet(f))
    feed = Feed(
        spark, source,
        {
            "reader": "warehouse_view", "mark_column": "o_orderdate", "file_format": "parquet", "as_text": True,
            "start_date": "1996-01-01", "end_date": "1997-01-01",
        },
    )
    feed.run(datetime(1997, 1, 1), incremental=False)
    loaded = feed.run(datetime(1997, 1, 11, 8), frequency="daily")
    return loaded.select("o_orderkey", "o_orderstatus", F.substring("o_orderdate", 1, 10).alias("day"))


@query(
    """
    SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
           CASE WHEN ts >= TIMESTAMP '2024-01-18' THEN value + 1 ELSE value END AS value
    FROM events
    """
)
def replay_replaces_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replayed stretch may replace its days instead of being appended: newest per key."""
    name = f"{fresh_schema()}.events"
    events = table(spark, sf_dir, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    tables.create_table_if_absent(spark, name, events.schema, new_folder(spark, "events"), ["day"])
    tables.replace_partitions(spark, name, events, gather=True)
    recent = events.where("day >= DATE '2024-01-18'")
    versions = rows.union_by_name(
        [recent.withColumn("loaded", F.lit(1)), recent.withColumns({"value": F.col("value") + 1, "loaded": F.lit(2)})]
    )
    newest = rows.one_per_key(versions, ["event_id"], ["loaded"]).drop("loaded")
    tables.replace_partitions(spark, name, newest, gather=True)
    return spark.table(name).withColumn("day", F.col("day").cast("string"))
