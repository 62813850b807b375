"""Loads that run as streams: each file once, bad messages aside, ledger-driven."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import all_string_schema, flatten_body, is_valid_json
from tidemark.functions.times import format_time
from tidemark.jobs import land_queue, load_queue
from tidemark.shared import new_folder
from tidemark.sinks import kept_marks
from tidemark.sinks.files import write_files
from tidemark.streaming.load import copy_into as load_files
from tidemark.streaming.messages import accepted, drain_messages

from .registry import query
from .shapes import broken_bodies
from .staging import fresh_schema, staged, table

AT = datetime(2024, 1, 31, 6, 15)
EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value")
EVENT_SCHEMA = (
    T.StructType().add("event_id", "long").add("user_id", "long").add("event_type", "string").add("value", "double")
)
MESSAGE_SCHEMA = all_string_schema(["MessageId", "ReceiptHandle", "Body", "RequestId", "HTTPHeaders"]).add(
    "RetryAttempts", "long"
)


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*EVENT_COLUMNS)


@query("SELECT event_id, user_id, event_type, value, TRUE AS has_source FROM events")
def copy_into_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_schema()}.events"
    source, target, checkpoint = (new_folder(spark, part) for part in ("landing", "events", "checkpoint"))

    def run():
        return load_files(spark, name, target, source, checkpoint, "json", EVENT_SCHEMA)

    events = events_of(spark, sf_dir)
    write_files(events.where("event_type <> 'click'"), source)
    run()
    repeated = run()
    if repeated.rows:
        raise AssertionError("a second run loaded files again")
    write_files(events.where("event_type = 'click'"), source)
    run()
    return spark.table(name).select(*EVENT_COLUMNS, (F.col("_metadata.file_size") > 0).alias("has_source"))


@query(
    """
    SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events
    """
)
def copy_into_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_schema()}.events"
    source, target, checkpoint = (new_folder(spark, part) for part in ("landing", "events", "checkpoint"))
    events = table(spark, sf_dir, "events")
    for parity, columns in ((0, ["event_id", "user_id"]), (1, ["event_id", "user_id", "event_type"])):
        write_files(events.where(F.col("event_id") % 2 == parity).select(*columns), source, "parquet")
        load_files(spark, name, target, source, checkpoint, "parquet")
    return spark.table(name).select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id, event_type, value FROM events")
def copy_into_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_schema()}.events"
    source = staged(spark, sf_dir, "events-csv", lambda f: write_files(events_of(spark, sf_dir), f, "csv"))
    load_files(spark, name, new_folder(spark, "events"), source, new_folder(spark, "checkpoint"), "csv", EVENT_SCHEMA)
    return spark.table(name).select(*EVENT_COLUMNS)


@query("SELECT max(date_trunc('second', ts)) AS mark, TRUE AS kept FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'")
def high_water_mark_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of text stamps; the mark is measured by the second one, not read from the table."""
    name, as_of = f"{fresh_schema()}.events", datetime(2024, 1, 20, 12)
    source, target, checkpoint = (new_folder(spark, part) for part in ("landing", "events", "checkpoint"))
    events = table(spark, sf_dir, "events").where(F.col("ts") <= F.lit(as_of))
    early = F.col("ts") < F.lit(datetime(2024, 1, 10))
    for wave in (events.where(early), events.where(~early)):
        write_files(wave.select(format_time("ts", "day_first").alias("created")), source)
        load_files(spark, name, target, source, checkpoint, "json")
        kept = [state.near for state in kept_marks.kept(spark, name).values()]
        found = kept_marks.text_mark(spark, name, "created", "day_first", as_of)
    return spark.createDataFrame([(found, kept == [found])], "mark timestamp_ntz, kept boolean")


def queue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a queue, some with bodies that are no JSON."""
    return broken_bodies(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("MessageId"),
        F.concat(F.lit("handle-"), F.col("event_id").cast("string")).alias("ReceiptHandle"),
        "Body",
        F.concat(F.lit("request-"), F.expr("event_id div 10").cast("string")).alias("RequestId"),
        F.to_json(F.create_map(F.lit("date"), F.col("event_type"))).alias("HTTPHeaders"),
        F.lit(0).cast("bigint").alias("RetryAttempts"),
    )


def waiting_messages(spark: SparkSession, sf_dir: str) -> str:
    """Message files as a queue's receiver leaves them."""
    return staged(spark, sf_dir, "messages", lambda f: write_files(queue_messages(spark, sf_dir), f))


@query("SELECT event_id, event_type FROM events WHERE event_id % 10 >= 4")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = new_folder(spark, "messages")
    drained = drain_messages(
        spark, waiting_messages(spark, sf_dir), landing, new_folder(spark, "checkpoint"), MESSAGE_SCHEMA
    )
    return accepted(spark, drained.paths).select(
        F.col("MessageId").cast("bigint").alias("event_id"), F.get_json_object("HTTPHeaders", "$.date").alias("event_type")
    )


@query(
    """
    SELECT count(*) AS received, count(*) FILTER (WHERE event_id % 10 >= 4) AS saved,
           count(*) FILTER (WHERE event_id % 10 < 4) AS rejected FROM events
    """
)
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    drained = drain_messages(
        spark, waiting_messages(spark, sf_dir), new_folder(spark, "messages"), new_folder(spark, "checkpoint"), MESSAGE_SCHEMA
    )
    return spark.createDataFrame([(drained.received, drained.saved, drained.rejected)], "received long, saved long, rejected long")


@query("SELECT event_id, event_type FROM events WHERE event_id % 10 >= 4")
def redelivered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue delivers some messages twice at once and all again later: each lands once."""
    source, landing, checkpoint = (new_folder(spark, part) for part in ("queue", "messages", "checkpoint"))
    sent, paths = queue_messages(spark, sf_dir), []
    number = F.col("MessageId").cast("bigint")
    first = sent.where(number % 3 != 0)
    for wave in (first.unionByName(first.where(number % 3 == 1)), sent):
        write_files(wave, source)
        paths += drain_messages(spark, source, landing, checkpoint, MESSAGE_SCHEMA, once_by="MessageId").paths
    return accepted(spark, paths).select(
        F.col("MessageId").cast("bigint").alias("event_id"), F.get_json_object("HTTPHeaders", "$.date").alias("event_type")
    )


@query(
    """
    SELECT count(*) AS received, count(*) FILTER (WHERE event_id % 10 >= 4) AS saved, 3 AS cycles,
           'low_throughput' AS stopped FROM events
    """
)
def watched_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages come in ever smaller waves; the drain ends with the first cycle that has few."""
    source, landing, checkpoint = (new_folder(spark, part) for part in ("queue", "messages", "checkpoint"))
    sent = queue_messages(spark, sf_dir)
    tenth = F.col("MessageId").cast("bigint") % 10
    waves = [sent.where(tenth < 5), sent.where(tenth.between(5, 8)), sent.where(tenth == 9)]
    few = sent.count() // 4
    write_files(waves.pop(0), source)

    def next_wave(folder: str) -> None:
        if waves:
            write_files(waves.pop(0), source)

    drained = drain_messages(
        spark, source, landing, checkpoint, MESSAGE_SCHEMA, on_landed=next_wave, cycle="1 second", few=few, max_seconds=600
    )
    row = (drained.received, drained.saved, len(drained.paths), drained.stopped)
    return spark.createDataFrame([row], "received long, saved long, cycles int, stopped string")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first micro-batch fails after its write; the replay must not double it."""
    name = f"{fresh_schema()}.events"
    source = staged(spark, sf_dir, "events-json-stream", lambda f: write_files(events_of(spark, sf_dir), f))
    target, checkpoint = new_folder(spark, "events"), new_folder(spark, "checkpoint")
    crash_after_first_write(spark, name, target, source, checkpoint)
    load_files(spark, name, target, source, checkpoint, "json", EVENT_SCHEMA)
    return spark.table(name).select(*EVENT_COLUMNS)


def crash_after_first_write(spark: SparkSession, name: str, target: str, source: str, checkpoint: str) -> None:
    """Run the load once with a crash between the table write and the checkpoint commit."""
    from pyspark.errors import StreamingQueryException

    def crash(label: str) -> None:
        raise RuntimeError(f"crash between write and commit of {label}")

    try:
        load_files(spark, name, target, source, checkpoint, "json", EVENT_SCHEMA, 1_000, on_loaded=crash)
    except StreamingQueryException:
        return
    raise AssertionError("the crash did not happen")


BODY_SCHEMA = all_string_schema(["k"])


@query(
    """
    SELECT CAST(json_extract(props, '$.k') AS VARCHAR) AS k, '{"date":"' || event_type || '"}' AS HTTPHeaders,
           CAST(0 AS BIGINT) AS RetryAttempts, CAST(event_id AS VARCHAR) AS MessageId, 'request-' || (event_id // 10) AS RequestId
    FROM events WHERE event_id % 10 >= 4
    """
)
def ledger_driven_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_schema()}.messages"
    landing, checkpoint, ledger, target = (
        new_folder(spark, part) for part in ("messages", "checkpoint", "ledger", "bronze")
    )
    land_queue(
        spark, waiting_messages(spark, sf_dir), landing, checkpoint, ledger, "orders", "prd", MESSAGE_SCHEMA, AT
    )
    load_queue(spark, ledger, "orders", "prd", name, target, BODY_SCHEMA, AT)
    if load_queue(spark, ledger, "orders", "prd", name, target, BODY_SCHEMA, AT):
        raise AssertionError("a folder was loaded twice")
    return spark.table(name).drop("_load_batch")


@query(
    """
    SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type, count(*) AS n_rows, max(event_id) AS last_id,
      'app' AS _data_source, 'files' AS _source_type, (SELECT count(*) FROM events) AS _qtd_rows
    FROM events GROUP BY 1, 2
    """
)
def bronze_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: landed JSON files, loaded once, payload checked and flattened, audited."""
    from tidemark.functions.audit import with_audit

    name = f"{fresh_schema()}.events"
    source = staged(
        spark, sf_dir, "events-payload",
        lambda f: write_files(table(spark, sf_dir, "events").select("event_id", "event_type", F.col("props").alias("Body")), f),
    )

    def shape(batch: DataFrame) -> DataFrame:
        good = batch.where(is_valid_json("Body"))
        return flatten_body(good, BODY_SCHEMA, envelope=["event_id", "event_type", "_metadata"])

    load_files(
        spark, name, new_folder(spark, "events"), source, new_folder(spark, "checkpoint"), "json",
        T.StructType().add("event_id", "long").add("event_type", "string").add("Body", "string"), shape=shape,
    )
    audited = with_audit(spark.table(name), {"_data_source": "app", "_source_type": "files"})
    return audited.groupBy(F.col("k").cast("bigint").alias("k"), "event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("event_id").alias("last_id"),
        *(F.max(c).alias(c) for c in ("_data_source", "_source_type", "_qtd_rows")),
    )
