"""Sinks, published tables and their maintenance."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import maintenance
from tidemark.config import TableSpec
from tidemark.functions.names import assert_legal_names, clean_column_names
from tidemark.shared import new_folder
from tidemark.sinks import files, tables

from .registry import query
from .staging import fresh_schema, table


SMALL_FILE_ROWS = 10_000


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def create_table_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, orders = f"{fresh_schema()}.orders", _orders(spark, sf_dir)
    folder = new_folder(spark, "orders")
    for wanted in (True, False):  # the second call finds the table
        if tables.create_table_if_absent(spark, name, orders.schema, folder) is not wanted:
            raise AssertionError("create_table_if_absent gave the wrong answer")
    tables.append_evolving(spark, name, orders)
    return spark.table(name)


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
    FROM orders
    """
)
def append_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, orders = f"{fresh_schema()}.orders", table(spark, sf_dir, "orders")
    old = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    new = orders.where("o_orderstatus <> 'F'").select("o_orderpriority", "o_totalprice", "o_custkey", "o_orderkey")
    tables.create_table_if_absent(spark, name, old.schema, new_folder(spark, "orders"))
    tables.append_evolving(spark, name, old)
    tables.append_evolving(spark, name, new)
    return spark.table(name)


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def overwrite_replaces_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, root = f"{fresh_schema()}.orders", new_folder(spark, "orders")
    tables.replace_table(spark, name, _orders(spark, sf_dir), root)
    tables.replace_table(spark, name, table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), root)
    return spark.table(name)


@query("SELECT p_partkey AS part_key, p_name AS part_name, p_retailprice AS price_BRL, TRUE AS has_source FROM part")
def staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_schema()}.part"
    awkward = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part key"), F.col("p_name").alias("part;name"), F.col("p_retailprice").alias("price (BRL)")
    )
    cleaned = assert_legal_names(clean_column_names(awkward))
    tables.staged_publish(spark, name, cleaned, new_folder(spark, "staging"), new_folder(spark, "part"))
    return spark.table(name).select(
        "part_key", "part_name", "price_BRL", F.col("_metadata.file_name").endswith(".json").alias("has_source")
    )


@query(
    """
    SELECT 'append' AS mode, 2 * count(*) AS n_rows FROM orders
    UNION ALL SELECT 'overwrite', count(*) FROM orders
    """
)
def write_mode_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = []
    for spec in (TableSpec("sales", "orders", mark_column="o_orderdate"), TableSpec("sales", "orders", mark_column="-")):
        folder = new_folder(spark, "policy")
        for _ in range(2):
            files.write_files(_orders(spark, sf_dir), folder, "parquet", spec.write_mode)
        counts.append(
            spark.read.parquet(folder).agg(F.lit(spec.write_mode.value).alias("mode"), F.count(F.lit(1)).alias("n_rows"))
        )
    return counts[0].unionByName(counts[1])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, orders = new_folder(spark, "guard"), _orders(spark, sf_dir)
    files.write_unless_empty(orders, folder, file_format="parquet")
    # an empty extract must not replace what is there
    files.write_unless_empty(orders.where("o_totalprice < 0"), folder, file_format="parquet", mode="overwrite")
    return spark.read.parquet(folder)


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '2024-01-31T06-15' ELSE '2024-01-31T07-15' END AS run
    FROM orders
    """
)
def run_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, orders = new_folder(spark, "runs"), table(spark, sf_dir, "orders")
    for hour, condition in ((6, "o_orderstatus = 'F'"), (7, "o_orderstatus <> 'F'")):
        target = files.run_folder(folder, datetime(2024, 1, 31, hour, 15))
        files.write_files(orders.where(condition).select("o_orderkey"), target, "parquet")
    return spark.read.parquet(folder).select("o_orderkey", F.col("run").cast("string").alias("run"))


@query("SELECT count(*) AS n_rows, TRUE AS within_limit FROM lineitem")
def max_records_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "flush")
    limit = 5_000
    files.write_files(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), folder, "parquet", max_records=limit
    )
    per_file = spark.read.parquet(folder).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= limit).alias("within_limit"))


def _small_files(spark: SparkSession, sf_dir: str, name: str, root: str) -> DataFrame:
    """Line items published as a version of many small files."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    tables.replace_table(spark, name, items, root, max_records=SMALL_FILE_ROWS)
    return items


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, root = f"{fresh_schema()}.lineitem", new_folder(spark, "lineitem")
    _small_files(spark, sf_dir, name, root)
    added, removed, _ = maintenance.compact_table(spark, name, root)
    if added > removed:
        raise AssertionError(f"compaction left {added} of {removed} files")
    return spark.table(name)


@query("SELECT l_returnflag, count(*) AS n_rows, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_returnflag")
def compact_partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, root = f"{fresh_schema()}.lineitem", new_folder(spark, "lineitem")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    tables.replace_table(spark, name, items, root, ["l_returnflag"], max_records=SMALL_FILE_ROWS)
    maintenance.compact_table(spark, name, root)
    return spark.table(name).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")
    )


@query("SELECT count(*) AS n_rows, TRUE AS listed, TRUE AS same_listing, 0 AS left_over FROM lineitem")
def expire_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, root = f"{fresh_schema()}.lineitem", new_folder(spark, "lineitem")
    items = _small_files(spark, sf_dir, name, root)
    tables.replace_table(spark, name, items, root)
    later = datetime.now(timezone.utc) + timedelta(hours=200)
    dry = maintenance.expire_versions(spark, name, root, as_of=later, dry_run=True).count()
    gone = maintenance.expire_versions(spark, name, root, as_of=later).count()
    again = maintenance.expire_versions(spark, name, root, as_of=later).count()
    return spark.table(name).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(dry > 0).alias("listed"), F.lit(dry == gone).alias("same_listing"),
        F.lit(again).alias("left_over"),
    )


@query(
    """
    SELECT 'lineitem' AS table_name, 'ok' AS status, TRUE AS no_more_files, count(*) AS n_rows FROM lineitem
    UNION ALL SELECT 'orders', 'ok', TRUE, count(*) FROM orders
    """
)
def maintenance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fresh_schema()
    _small_files(spark, sf_dir, f"{schema}.lineitem", new_folder(spark, "lineitem"))
    tables.replace_table(spark, f"{schema}.orders", _orders(spark, sf_dir), new_folder(spark, "orders"))
    others = [d.name for d in spark.catalog.listDatabases() if d.name != schema]
    report = maintenance.maintain(spark, excluded=others)
    counts = spark.table(f"{schema}.lineitem").agg(F.lit("lineitem").alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
    counts = counts.unionByName(
        spark.table(f"{schema}.orders").agg(F.lit("orders").alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
    )
    shaped = report.select(
        F.split_part("table", F.lit("."), F.lit(-1)).alias("table_name"), "status",
        (F.col("files_added") <= F.col("files_removed")).alias("no_more_files"),
    )
    return shaped.join(counts, "table_name")
