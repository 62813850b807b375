"""Incremental predicates, marks, windows, joins, duplicates, unions, the ledger."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import format_time
from tidemark.operators import filters, joins, ledger, marks, rows, windows
from tidemark.shared import new_folder
from tidemark.sources.databases import incremental_condition

from .registry import query
from .staging import table

AS_OF = datetime(2024, 1, 20, 12, 0)
AT = datetime(2024, 1, 31, 6, 15)


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-30 00:00:00'")
def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return filters.newer_than(orders, "o_orderdate", datetime(1997, 6, 30))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > '1998-01-15 00:00:00'")
def incremental_condition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = incremental_condition("o_orderdate >", datetime(1998, 1, 15))
    return filters.matching(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), condition)


@query(
    """
    SELECT event_id, ts FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00')
    """
)
def incremental_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return filters.newer_than(events, "ts", marks.last_mark(events, "ts", AS_OF))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def static_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return filters.matching(orders, "o_orderstatus = 'F' AND o_totalprice > 100000").select(
        "o_orderkey", "o_orderpriority"
    )


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20'")
def text_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("created", format_time("ts", "day_first"))
    day = filters.text_time_between(
        events, "created", datetime(2024, 1, 19), datetime(2024, 1, 19, 23, 59, 59)
    )
    return day.select("event_id", "ts")


@query(
    """
    SELECT event_id FROM events
    WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-19 03:00:00' AND TIMESTAMP '2024-01-20 02:59:59'
    """
)
def zoned_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.concat(F.substring(format_time("ts", "iso_millis"), 1, 19), F.lit("+00:00"))
    events = table(spark, sf_dir, "events").select("event_id", iso.alias("created"))
    return filters.instant_between(
        events, "created", "2024-01-19T00:00:00-03:00", "2024-01-19T23:59:59-03:00"
    ).select("event_id")


@query(
    """
    SELECT event_id, user_id FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-05' AND CAST(ts AS DATE) < DATE '2024-01-09'
    """
)
def half_open_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return filters.on_days(events, "ts", date(2024, 1, 5), date(2024, 1, 9)).select("event_id", "user_id")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-04-01'
    """
)
def manual_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return filters.in_range(items, "l_shipdate", datetime(1996, 1, 1), datetime(1996, 4, 1)).drop("l_shipdate")


@query("SELECT max(ts) AS mark FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'")
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marks.high_water_mark(table(spark, sf_dir, "events"), "ts", AS_OF)


@query("SELECT max(ts) AS mark FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'")
def high_water_mark_from_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the mark of five days before is kept; only what came after it is looked at
    return marks.high_water_mark(table(spark, sf_dir, "events"), "ts", AS_OF, at_least=AS_OF - timedelta(days=5))


@query("SELECT max(date_trunc('second', ts)) AS mark FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'")
def high_water_mark_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    # day-first text: its own maximum would be a day 31
    events = table(spark, sf_dir, "events").select(format_time("ts", "day_first").alias("created"))
    return marks.high_water_mark(events, "created", AS_OF, "day_first")


@query(
    """
    SELECT event_id, event_type, n_messages, first_id, last_id
    FROM events, (SELECT count(*) AS n_messages, min(event_id) AS first_id, max(event_id) AS last_id FROM events) m
    """
)
def cross_join_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").select("event_id", "event_type")
    metadata = messages.agg(
        F.count(F.lit(1)).alias("n_messages"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )
    return joins.attach_metadata(messages, metadata)


@query(
    """
    SELECT event_id, receive_id, request_id, attempts
    FROM (SELECT event_id, event_id // 10 AS receive_id FROM events) e
    JOIN (SELECT event_id // 10 AS receive_id, 'r-' || min(event_id) AS request_id, count(*) AS attempts
          FROM events GROUP BY 1) m USING (receive_id)
    """
)
def receive_metadata_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").select("event_id", F.expr("event_id div 10").alias("receive_id"))
    metadata = messages.groupBy("receive_id").agg(
        F.concat(F.lit("r-"), F.min("event_id").cast("string")).alias("request_id"), F.count(F.lit(1)).alias("attempts")
    )
    return joins.attach_metadata(messages, metadata, "receive_id")


@query(
    """
    SELECT w.start AS start, count(*) AS n_rows, CAST(sum(e.event_id) AS BIGINT) AS id_sum
    FROM events e
    JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-16', TIMESTAMP '2024-01-20 08:00:00', INTERVAL 8 HOUR)) AS start) w
      ON e.ts >= w.start AND e.ts < least(w.start + INTERVAL 8 HOUR, TIMESTAMP '2024-01-20 12:00:00')
    GROUP BY w.start
    """
)
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    rule = windows.WindowRule("daily", days=5, per_day=3)
    slices = windows.window_for(spark, rule, AS_OF, AS_OF)
    return joins.in_windows(events, "ts", slices).groupBy("start").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum")
    )


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-20 12:00:00'")
def interval_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = windows.WindowRule("daily", days=5, per_day=2)
    slices = windows.window_for(spark, rule, AS_OF, AS_OF)
    return joins.in_windows_union(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", slices)


def user_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event of each user up to ``AS_OF``."""
    events = table(spark, sf_dir, "events").select("user_id", "ts")
    seen = events.where(F.col("ts") <= F.lit(str(AS_OF)).cast("timestamp_ntz"))
    return seen.groupBy("user_id").agg(F.max("ts").alias("mark"))


USER_MARKS_SQL = "(SELECT user_id, max(ts) AS mark FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY user_id)"


@query(
    f"""
    SELECT user_id, start, least(start + INTERVAL 8 HOUR, TIMESTAMP '2024-01-20 12:00:00') AS stop
    FROM (SELECT user_id, unnest(generate_series(date_trunc('day', mark) - INTERVAL 1 DAY,
                                                 TIMESTAMP '2024-01-20 12:00:00', INTERVAL 8 HOUR)) AS start
          FROM {USER_MARKS_SQL} m) s
    WHERE start < TIMESTAMP '2024-01-20 12:00:00'
    """
)
def subday_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = windows.lookback_start(F.col("mark"), 2)
    slices = windows.subday_slices(user_marks(spark, sf_dir), start, windows.wall_time(AS_OF), 3)
    return slices.select("user_id", "start", "stop")


@query(
    f"""
    SELECT user_id, day AS start, day + INTERVAL 1 DAY AS stop
    FROM (SELECT user_id, unnest(generate_series(date_trunc('day', mark) + INTERVAL 1 DAY,
                                                 TIMESTAMP '2024-01-19', INTERVAL 1 DAY)) AS day
          FROM {USER_MARKS_SQL} m WHERE mark < TIMESTAMP '2024-01-19') s
    """
)
def daily_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = windows.whole_days(user_marks(spark, sf_dir), F.col("mark"), AS_OF.date())
    return days.select("user_id", "start", "stop")


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20'")
def yesterday_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return filters.in_range(events, "ts", *windows.yesterday(AS_OF.date())).drop("ts")


@query(f"SELECT user_id, date_trunc('day', mark) - INTERVAL 4 DAY AS start FROM {USER_MARKS_SQL} m")
def lookback_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_marks(spark, sf_dir).select("user_id", windows.lookback_start(F.col("mark"), 5).alias("start"))


@query(
    """
    WITH m AS (SELECT max(ts) AS mark FROM events WHERE ts <= TIMESTAMP '2024-01-10'),
    w AS (
      SELECT 'hourly' AS rule, mark AS start, TIMESTAMP '2024-01-20 12:00:00' AS stop FROM m
      UNION ALL
      SELECT 'lookback', start, least(start + INTERVAL 12 HOUR, TIMESTAMP '2024-01-20 12:00:00')
      FROM (SELECT unnest(generate_series(date_trunc('day', mark) - INTERVAL 2 DAY, TIMESTAMP '2024-01-20',
                                          INTERVAL 12 HOUR)) AS start FROM m) a
      UNION ALL
      SELECT 'whole_days', start, start + INTERVAL 1 DAY
      FROM (SELECT unnest(generate_series(date_trunc('day', mark) + INTERVAL 1 DAY, TIMESTAMP '2024-01-19',
                                          INTERVAL 1 DAY)) AS start FROM m) b
      UNION ALL
      SELECT 'manual', TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-03 06:00:00'
    )
    SELECT rule, start, stop, count(*) AS n_rows FROM w JOIN events e ON e.ts >= w.start AND e.ts < w.stop
    GROUP BY rule, start, stop
    """
)
def window_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("ts")
    mark = marks.last_mark(events, "ts", datetime(2024, 1, 10))
    rules = {
        "hourly": windows.WindowRule("hourly"),
        "lookback": windows.WindowRule("daily", days=3, per_day=2),
        "whole_days": windows.WindowRule("daily", whole_days=True),
        "manual": windows.WindowRule("manual", start=datetime(2024, 1, 2), stop=datetime(2024, 1, 3, 6)),
    }
    frames = [
        windows.window_for(spark, rule, mark, AS_OF).select(F.lit(name).alias("rule"), "start", "stop")
        for name, rule in rules.items()
    ]
    found = joins.in_windows(events, "ts", rows.union_by_name(frames))
    return found.groupBy("rule", "start", "stop").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def drop_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    return rows.distinct_rows(rows.union_by_position([events, events]))


@query(
    """
    SELECT o_custkey, o_orderkey, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders) o
    WHERE place = 1
    """
)
def drop_duplicates_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return rows.one_per_key(orders, ["o_custkey"], ["o_orderdate"])


@query("SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id")
def order_by_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.ordered_by(table(spark, sf_dir, "events").select("event_id", "ts", "event_type"), "ts", "event_id")


@query("SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return rows.union_by_position([customers, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")])


def _parties(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return customers, suppliers


@query(
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.union_by_name(_parties(spark, sf_dir))


@query(
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier"
)
def union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, suppliers = _parties(spark, sf_dir)
    return rows.union_by_name([customers, suppliers.drop("balance")], allow_missing=True)


def order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger: a path per customer; finished orders mark it read, some entries are no paths."""
    path = F.when(F.col("o_orderkey") % 50 == 0, F.lit("null")).when(F.col("o_orderkey") % 50 != 1, F.concat(
        F.lit("landing/"), F.col("o_custkey").cast("string")))
    return table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("queue"), path.alias("path"), (F.col("o_orderstatus") == "F").alias("readed"),
        F.when(F.col("o_orderpriority") == "5-LOW", "dev").otherwise("prd").alias("env"),
        format_time("o_orderdate", "iso_minute").alias("ts"),
    )


ORDER_LEDGER_SQL = """
    (SELECT CASE o_orderkey % 50 WHEN 0 THEN 'null' WHEN 1 THEN NULL ELSE 'landing/' || o_custkey END AS path,
            o_orderstatus = 'F' AS readed
     FROM orders WHERE o_orderpriority <> '5-LOW')
"""


@query(f"SELECT DISTINCT path, readed FROM {ORDER_LEDGER_SQL} l")
def ledger_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger_entries(order_ledger(spark, sf_dir), "orders", "prd")


@query(
    f"SELECT path FROM {ORDER_LEDGER_SQL} l WHERE path IS NOT NULL AND path <> 'null' GROUP BY path HAVING NOT bool_or(readed)"
)
def unread_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.unread_paths(ledger.ledger_entries(order_ledger(spark, sf_dir), "orders", "prd"))


@query(
    """
    SELECT 'landing/' || o_custkey AS path FROM orders GROUP BY o_custkey HAVING NOT bool_or(o_orderstatus = 'F')
    """
)
def ledger_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "ledger")
    orders = table(spark, sf_dir, "orders").withColumn("path", F.concat(F.lit("landing/"), F.col("o_custkey").cast("string")))
    ledger.append_entries(folder, ledger.entries_for(orders, "orders", "prd", False, AT))
    ledger.append_entries(folder, ledger.entries_for(orders.where("o_orderstatus = 'F'"), "orders", "prd", True, AT))
    return ledger.unread_paths(ledger.ledger_entries(ledger.read_ledger(spark, folder), "orders", "prd"))


@query(
    """
    SELECT env, path FROM (
        SELECT 'landing/' || o_custkey AS path, CASE WHEN o_custkey % 5 = 0 THEN 'dev' ELSE 'prd' END AS env, o_orderstatus
        FROM orders) l
    GROUP BY env, path HAVING NOT bool_or(o_orderstatus = 'F')
    """
)
def ledger_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many runs append to the ledger of two environments; folds keep its files few and its answer the same."""
    folder, most = new_folder(spark, "ledger"), 3
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("queue"),
        F.concat(F.lit("landing/"), F.col("o_custkey").cast("string")).alias("path"),
        (F.col("o_orderstatus") == "F").alias("readed"),
        F.when(F.col("o_custkey") % 5 == 0, "dev").otherwise("prd").alias("env"),
        format_time("o_orderdate", "iso_minute").alias("ts"),
        (F.col("o_orderkey") % 6).alias("run"),
    )
    for run in range(6):
        ledger.append_entries(folder, orders.where(F.col("run") == run).drop("run").coalesce(2))
        for env in ("dev", "prd"):
            ledger.fold_ledger(spark, folder, "orders", env, most)
    book = ledger.read_ledger(spark, folder)
    if book.select("_metadata.file_path").distinct().count() > 2 * most:
        raise AssertionError("folds left many files")
    parts = [ledger.unread_paths(ledger.ledger_entries(book, "orders", env)).withColumn("env", F.lit(env)) for env in ("dev", "prd")]
    return parts[0].unionByName(parts[1]).select("env", "path")
