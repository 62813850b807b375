"""Input that is late, wider than before, ordered otherwise or broken must load whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.payload import is_valid_json
from tidemark.shared import filesystem, new_folder, pinned_session
from tidemark.sinks.files import write_files
from tidemark.sources.files import report_rows
from tidemark.maintenance import compact_table
from tidemark.streaming.load import copy_into, set_aside
from tidemark.streaming.messages import accepted, drain_messages, rejected

from .registry import query
from .staging import fresh_schema, staged, write_lines
from .streams import EVENT_COLUMNS, EVENT_SCHEMA, MESSAGE_SCHEMA, events_of


def _files(spark: SparkSession, folder: str) -> set[str]:
    fs, path = filesystem(spark, folder)
    return {status.getPath().toString() for status in fs.listStatus(path) if status.isFile()}


def _age(spark: SparkSession, files: set[str], days: int) -> None:
    """Give files a modification time long ago, as a restore does."""
    for file in files:
        fs, path = filesystem(spark, file)
        fs.setTimes(path, fs.getFileStatus(path).getModificationTime() - days * 86_400_000, -1)


@query("SELECT event_id, user_id, event_type, value FROM events")
def copy_into_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are a month older than those already loaded."""
    name = f"{fresh_schema()}.events"
    source, target, checkpoint = (new_folder(spark, part) for part in ("landing", "events", "checkpoint"))
    events = events_of(spark, sf_dir)
    write_files(events.where("event_type <> 'click'"), source)
    copy_into(spark, name, target, source, checkpoint, "json", EVENT_SCHEMA)
    before = _files(spark, source)
    write_files(events.where("event_type = 'click'"), source)
    _age(spark, _files(spark, source) - before, 30)
    copy_into(spark, name, target, source, checkpoint, "json", EVENT_SCHEMA)
    return spark.table(name).select(*EVENT_COLUMNS)


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id ELSE value END::DOUBLE AS v FROM events")
def copy_into_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers first, fractions later; no value may change, in one batch or in two."""
    events, source = events_of(spark, sf_dir), new_folder(spark, "landing")
    names, targets, checkpoints = ([f(part) for part in ("two", "one")] for f in (lambda _: f"{fresh_schema()}.events", lambda p: new_folder(spark, p), lambda p: new_folder(spark, f"checkpoint-{p}")))
    for parity, column in ((0, F.col("user_id")), (1, F.col("value"))):
        write_files(events.where(F.col("event_id") % 2 == parity).select("event_id", column.alias("v")), source)
        copy_into(spark, names[0], targets[0], source, checkpoints[0])
    copy_into(spark, names[1], targets[1], source, checkpoints[1])
    two, one = (spark.table(name).select("event_id", "v") for name in names)
    if one.dtypes != two.dtypes or one.exceptAll(two).limit(1).count():
        raise AssertionError("the batches decided the result")
    return two


@query(
    """
    SELECT k, form, CASE WHEN form = 0 THEN (9007199254740992 + 2 * k + 1)::VARCHAR ELSE k || '.5' END AS v
    FROM (SELECT event_id AS k FROM events), (SELECT unnest([0, 1]) AS form)
    """
)
def copy_into_exact_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers that no double can hold beside fractions: every digit stays, in one batch or in two."""
    rows = events_of(spark, sf_dir).select(F.col("event_id").alias("k"), F.explode(F.array(F.lit(0), F.lit(1))).alias("form"))
    long = F.lit(9007199254740992) + 2 * F.col("k") + 1
    number = F.when(F.col("form") == 0, long.cast("string")).otherwise(F.concat(F.col("k").cast("string"), F.lit(".5")))
    lines = rows.select("form", F.format_string('{"k":%d,"form":%d,"v":%s}', "k", "form", number).alias("value"))
    source, results = new_folder(spark, "landing"), []
    names = [f"{fresh_schema()}.numbers" for _ in range(2)]
    two, one = ((name, new_folder(spark, "numbers"), source, new_folder(spark, "checkpoint")) for name in names)
    for form in (0, 1):
        lines.where(F.col("form") == form).select("value").write.mode("append").text(source)
        copy_into(spark, *two)
    copy_into(spark, *one)
    for name in names:
        results.append(spark.table(name).select("k", F.col("form").cast("int").alias("form"), "v"))
    if results[0].exceptAll(results[1]).limit(1).count():
        raise AssertionError("the batches decided the result")
    return results[0]


@query(
    """
    SELECT event_id::VARCHAR AS event_id, CASE WHEN event_id % 4 < 3 THEN user_id::VARCHAR END AS user_id, event_type,
      CASE WHEN event_id % 4 = 2 THEN 'x' || event_id END AS note FROM events
    """
)
def copy_into_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files of two widths and two orders, some in one batch: each is read under its own header."""
    name = f"{fresh_schema()}.events"
    source, target, checkpoint = (new_folder(spark, part) for part in ("landing", "events", "checkpoint"))
    events = events_of(spark, sf_dir).withColumn("note", F.concat(F.lit("x"), F.col("event_id").cast("string")))
    layouts = (["event_id", "user_id", "event_type"], ["event_type", "user_id", "event_id"], ["event_id", "user_id", "event_type", "note"], ["event_type", "event_id"])
    for batch in (layouts[:3], layouts[3:]):
        for columns in batch:
            part = events.where(F.col("event_id") % 4 == layouts.index(columns)).select(*columns)
            write_files(part, source, "csv")
        copy_into(spark, name, target, source, checkpoint, "csv")
    return spark.table(name).select("event_id", "user_id", "event_type", "note")


@query(
    """
    SELECT event_id % 6 <> 0 AS ok, CASE WHEN event_id % 6 <> 0 THEN event_id END AS event_id,
      CASE event_id % 6 WHEN 0 THEN '{"event_id":' || event_id || ',"event_type":"' END AS line FROM events
    """
)
def copy_into_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines that were cut off are set aside as received; no row of nulls takes their place."""

    def build(folder: str) -> None:
        event = F.col("event_id").cast("string")
        cut = F.concat(F.lit('{"event_id":'), event, F.lit(',"event_type":"'))
        whole = F.concat(cut, F.col("event_type"), F.lit('"}'))
        events_of(spark, sf_dir).select(F.when(F.col("event_id") % 6 == 0, cut).otherwise(whole).alias("value")).write.text(folder)

    name = f"{fresh_schema()}.events"
    source = staged(spark, sf_dir, "events-cut", build)
    copy_into(spark, name, new_folder(spark, "events"), source, new_folder(spark, "checkpoint"), "json", EVENT_SCHEMA)
    good = spark.table(name).select(F.lit(True).alias("ok"), "event_id", F.lit(None).cast("string").alias("line"))
    return good.union(set_aside(spark, name).select(F.lit(False), F.lit(None).cast("long"), "line"))


@query(
    """
    SELECT event_id, event_type AS kind, 2 AS bad_files FROM events
    """
)
def copy_into_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that is no Parquet and one whose column is a structure are set aside; good files before, beside and after them load."""
    name = f"{fresh_schema()}.events"
    source, target, checkpoint = (new_folder(spark, part) for part in ("landing", "events", "checkpoint"))
    events = events_of(spark, sf_dir).select("event_id", F.col("event_type").alias("kind"))
    bad = 0
    for part in range(3):
        write_files(events.where(F.col("event_id") % 3 == part), source, "parquet")
        if part == 1:
            events.limit(5).select("event_id", F.struct("kind").alias("kind")).coalesce(1).write.mode("append").parquet(source)
        if part == 2:
            events.select(F.col("kind").alias("value")).coalesce(1).write.mode("append").option("mapreduce.output.basename", "broken").text(source)
        bad += copy_into(spark, name, target, source, checkpoint, "parquet").bad_files
    if set_aside(spark, name).where("line IS NULL AND reason IS NOT NULL").count() != bad:
        raise AssertionError("a bad file is not listed")
    return spark.table(name).select("event_id", "kind", F.lit(bad).alias("bad_files"))


@query("SELECT event_id, user_id, event_type, value, TRUE AS fewer, TRUE AS settled FROM events")
def compact_loaded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve loads, then folding: fewer files, nothing to do the second time, and the rows as before."""
    name = f"{fresh_schema()}.events"
    source, target, checkpoint = (new_folder(spark, part) for part in ("landing", "events", "checkpoint"))
    events = events_of(spark, sf_dir)
    for part in range(12):
        write_files(events.where(F.col("event_id") % 12 == part), source, "parquet")
        copy_into(spark, name, target, source, checkpoint, "parquet", EVENT_SCHEMA)
    added, removed, _ = compact_table(spark, name, "")
    again = compact_table(spark, name, "")
    return spark.table(name).select(*EVENT_COLUMNS, F.lit(added < removed).alias("fewer"), F.lit(again == (0, 0, 0)).alias("settled"))


@query(
    """
    SELECT event_id, user_id AS id, CASE WHEN event_id % 2 = 1 THEN event_type END AS kind,
      CASE WHEN event_id % 2 = 1 THEN value END AS amount FROM events
    """
)
def copy_into_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New fields inside a structure, one with a name that needs quotes."""
    name = f"{fresh_schema()}.events"
    source, target, checkpoint = (new_folder(spark, part) for part in ("landing", "events", "checkpoint"))
    events = events_of(spark, sf_dir)
    old = F.struct(F.col("user_id").alias("id"))
    new = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("content-type"), F.struct(F.col("value").alias("amount")).alias("deep"))
    for parity, body in ((0, old), (1, new)):
        write_files(events.where(F.col("event_id") % 2 == parity).select("event_id", body.alias("body")), source, "parquet")
        copy_into(spark, name, target, source, checkpoint, "parquet")
    body = F.col("body")
    return spark.table(name).select("event_id", body["id"].alias("id"), body["content-type"].alias("kind"), body["deep"]["amount"].alias("amount"))


@query("SELECT event_id::VARCHAR AS Event_Id, user_id::VARCHAR AS User_Id, event_type AS Kind FROM events")
def reports_other_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report files whose columns stand in another order keep their values under their names."""

    def build(folder: str) -> None:
        events = events_of(spark, sf_dir)
        names = [F.col("event_id").alias("Event Id"), F.col("user_id").alias("User Id"), F.col("event_type").alias("Kind")]
        for part, columns in enumerate((names, names[::-1])):
            events.where(F.col("event_id") % 2 == part).select(*columns).write.mode("append").csv(folder, header=True)

    return report_rows(spark, staged(spark, sf_dir, "reports-order", build)).select("Event_Id", "User_Id", "Kind")


@query("SELECT event_id::VARCHAR AS event_id, 'a' || chr(10) || chr(10) || event_type || ',\"' || user_id || chr(10) AS note FROM events")
def quoted_csv_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports whose fields hold line breaks, commas and quotes, each file cut into many splits."""

    def build(folder: str) -> None:
        note = F.concat(F.lit('"a\n\n'), F.col("event_type"), F.lit(',""'), F.col("user_id").cast("string"), F.lit('\n"'))
        lines = events_of(spark, sf_dir).select(F.concat_ws(",", F.col("event_id").cast("string"), note).alias("line"))
        write_lines(lines.coalesce(2), F.col("line"), "event id,note", folder)

    folder = staged(spark, sf_dir, "reports-breaks", build)
    small = pinned_session(spark, **{"spark.sql.files.maxPartitionBytes": 64 << 10})
    return report_rows(small, folder).select("event_id", "note")


@query(
    """
    SELECT event_id, form, form IN (0, 3, 4) AS ok FROM events, (SELECT unnest(range(6)) AS form)
    """
)
def strict_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only JSON is JSON: no single quotes, raw line breaks or trailing text; repeated keys and null are."""
    kind = F.col("event_type")
    forms = [
        F.concat(F.lit('{"a": "'), kind, F.lit('"}')),
        F.concat(F.lit("{'a': '"), kind, F.lit("'}")),
        F.concat(F.lit('{"a": "'), kind, F.lit("\n"), kind, F.lit('"}')),
        F.concat(F.lit('{"a": "'), kind, F.lit('", "a": 1}')),
        F.lit("null"),
        F.concat(F.lit('{"a": 1} '), kind),
    ]
    rows = events_of(spark, sf_dir).select("event_id", F.posexplode(F.array(*forms)).alias("form", "body"))
    return rows.select("event_id", "form", is_valid_json("body").alias("ok"))


@query(
    """
    SELECT event_id % 5 <> 0 AS ok, CASE WHEN event_id % 5 = 0 THEN '{"MessageId":"' || event_id || '","Bo'
      ELSE '{"id":' || event_id || '}' END AS body FROM events
    """
)
def broken_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message lines that were cut off are set aside as they came."""

    def build(folder: str) -> None:
        event = F.col("event_id").cast("string")
        cut = F.concat(F.lit('{"MessageId":"'), event, F.lit('","Bo'))
        whole = F.to_json(F.struct(event.alias("MessageId"), F.concat(F.lit('{"id":'), event, F.lit("}")).alias("Body")))
        events_of(spark, sf_dir).select(F.when(F.col("event_id") % 5 == 0, cut).otherwise(whole).alias("value")).write.text(folder)

    source = staged(spark, sf_dir, "messages-cut", build)
    done = drain_messages(spark, source, new_folder(spark, "landed"), new_folder(spark, "checkpoint"), MESSAGE_SCHEMA)
    good, bad = accepted(spark, done.paths), rejected(spark, done.paths)
    return good.select(F.lit(True).alias("ok"), F.col("Body").alias("body")).union(bad.select(F.lit(False), "Body"))
