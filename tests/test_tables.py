from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import maintenance
from tidemark.sinks import files, tables
from tidemark.sources.catalog import list_tables


def test_modes():
    mode = files.WriteMode
    assert mode.for_mark_column("-") is mode.OVERWRITE and mode.for_mark_column("ts") is mode.APPEND
    assert mode.of(["append"]) is mode.APPEND and mode.of("overwrite") is mode.OVERWRITE
    with pytest.raises(ValueError):
        mode.of("merge")


def test_write_files(spark, tmp_path):
    df = spark.createDataFrame([(1, None, ' a "b",\nc ')], "i int, n string, s string")
    for fmt in files.FORMATS:
        folder = str(tmp_path / fmt)
        files.write_files(df, folder, fmt)
        files.write_files(df, folder, fmt)
        back = spark.read.format(fmt)
        if fmt == "csv":
            back = back.options(header=True, multiLine=True, escape='"')
        got = back.load(folder)
        assert set(got.columns) == {"i", "n", "s"} and got.count() == 2
        assert got.first().s == ' a "b",\nc '
    with pytest.raises(ValueError, match="landing format"):
        files.write_files(df, str(tmp_path / "x"), "orc")


def test_file_counts(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4)
    files.write_files(df, str(tmp_path / "one"), "parquet", files=1)
    files.write_files(df, str(tmp_path / "many"), "parquet", files=1, max_records=300)
    assert maintenance.data_files(spark, str(tmp_path / "one")).count() == 1
    assert maintenance.data_files(spark, str(tmp_path / "many")).count() == 4


def test_empty_guard(spark, tmp_path):
    folder = str(tmp_path / "g")
    assert files.write_unless_empty(spark.range(2), folder, file_format="parquet")
    assert not files.write_unless_empty(spark.range(0), folder, file_format="parquet", mode="overwrite")
    assert spark.read.parquet(folder).count() == 2


def test_run_folder(spark):
    at = datetime(2024, 1, 31, 6, 15, 59)
    assert files.run_folder("a/b/", at) == "a/b/run=2024-01-31T06-15"
    assert files.with_run(spark.range(1), at).first().run == "2024-01-31T06-15"


def test_create_append_evolve(spark, tmp_path, schema_name):
    name = f"{schema_name}.t"
    base = spark.createDataFrame([(1, "a")], "i int, s string")
    assert tables.create_table_if_absent(spark, name, base.schema, str(tmp_path / "t"))
    assert not tables.create_table_if_absent(spark, name, base.schema, str(tmp_path / "t"))
    assert tables.append_evolving(spark, name, base) == []
    wider = spark.createDataFrame([("b", 2.5, 2)], "S string, extra double, i int")
    assert tables.append_evolving(spark, name, wider) == ["extra"]
    assert tables.append_evolving(spark, name, spark.createDataFrame([(3,)], "i int")) == []
    got = sorted(map(tuple, spark.table(name).collect()))
    assert got == [(1, "a", None), (2, "b", 2.5), (3, None, None)]
    assert tables.table_location(spark, name).endswith("/t")


def test_replace_partitions_keeps_the_others(spark, tmp_path, schema_name):
    name = f"{schema_name}.p"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, part string")
    tables.create_table_if_absent(spark, name, df.schema, str(tmp_path / "p"), ["part"])
    before = spark.conf.get(tables.OVERWRITE_MODE)
    tables.replace_partitions(spark, name, df)
    tables.replace_partitions(spark, name, spark.createDataFrame([(20, "b"), (30, "c")], "i int, part string"))
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (20, "b"), (30, "c")]
    assert spark.conf.get(tables.OVERWRITE_MODE) == before
    plain = f"{schema_name}.plain"
    tables.create_table_if_absent(spark, plain, df.schema, str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="no partitions"):
        tables.replace_partitions(spark, plain, df)


def test_replace_table(spark, tmp_path, schema_name):
    name, root = f"{schema_name}.r", str(tmp_path / "r")
    first = tables.replace_table(spark, name, spark.range(3), root)
    second = tables.replace_table(spark, name, spark.range(2), root)
    assert first != second and spark.table(name).count() == 2
    tables.replace_table(spark, name, spark.createDataFrame([("x",)], "s string"), root)
    assert spark.table(name).columns == ["s"] and spark.table(name).first().s == "x"
    assert spark.read.parquet(first).count() == 3  # old versions stay until they expire


def test_failed_replace_changes_nothing(spark, tmp_path, schema_name):
    name, root = f"{schema_name}.r", str(tmp_path / "r")
    tables.replace_table(spark, name, spark.range(3), root)
    broken = spark.range(3).withColumn("id", F.raise_error(F.lit("broken row")).cast("long"))
    with pytest.raises(Exception, match="broken row"):
        tables.replace_table(spark, name, broken, root)
    assert spark.table(name).count() == 3


def test_staged_publish_keeps_provenance(spark, tmp_path, schema_name):
    name = f"{schema_name}.s"
    tables.staged_publish(spark, name, spark.range(3), str(tmp_path / "stage"), str(tmp_path / "s"))
    got = spark.table(name)
    assert got.columns == ["id", "_metadata"]
    assert got.select(F.col("_metadata.file_name").endswith(".json")).distinct().first()[0]


def test_version_names():
    at = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    folder = tables.new_version("/r/", "s.t", at).rsplit("/", 1)[-1]
    assert tables.version_time(folder, "s.t") == at
    assert tables.version_time(folder, "s.t2") is None and tables.version_time("data", "s.t") is None
    assert tables.version_time(tables.new_version("", "s.t-x", at)[1:], "s.t") is None


def small_files(spark, name, root, **options):
    df = spark.range(0, 1000, 1, 8).withColumn("k", (F.col("id") % 3).cast("string"))
    tables.replace_table(spark, name, df, root, max_records=10, **options)


def test_compact(spark, tmp_path, schema_name):
    name, root = f"{schema_name}.c", str(tmp_path / "c")
    small_files(spark, name, root)
    added, removed, size = maintenance.compact_table(spark, name, root)
    assert added == 1 and removed >= 100 and size > 0
    assert spark.table(name).agg(F.sum("id")).first()[0] == 499_500
    assert maintenance.compact_table(spark, name, root) == (0, 0, 0)


def test_compacting_tasks_write_what_they_read(spark, tmp_path, schema_name, monkeypatch):
    from plans import parquet_writes

    name, root = f"{schema_name}.c", str(tmp_path / "c")
    small_files(spark, name, root)
    size = maintenance._size(spark, tables.table_location(spark, name))[1]
    seen = parquet_writes(monkeypatch)
    assert maintenance.compact_table(spark, name, root, size // 4 + 1)[0] == 4
    # a row dealt out may take many times what it takes in a file, so a task read far more than a file's bytes
    assert [("Exchange" in plan, tasks) for plan, tasks in seen] == [(False, 4)]
    rows = spark.table(name).groupBy("_metadata.file_path").agg(F.count("*").alias("n"), F.sum("id").alias("ids")).collect()
    assert sum(r.n for r in rows) == 1000 and sum(r.ids for r in rows) == 499_500 and max(r.n for r in rows) <= 400


def test_compacting_shares_large_files_out(spark, tmp_path, schema_name, monkeypatch):
    name, root = f"{schema_name}.c", str(tmp_path / "c")
    noise = F.sha2(F.col("id").cast("string"), 512).alias("v")
    folder = tables.replace_table(spark, name, spark.range(0, 8000, 1, 4).select("id", noise), root)
    spark.range(8000, 8060, 1, 60).select("id", noise).write.mode("append").parquet(folder)
    spark.catalog.refreshTable(name)
    files, size = maintenance._size(spark, folder)
    assert files == 64
    added = maintenance.compact_table(spark, name, root, size // 4 + 1)[0]
    rows = [r.n for r in spark.table(name).groupBy("_metadata.file_path").agg(F.count("*").alias("n")).collect()]
    # the four large files do not all go to the task that comes first
    assert added == 4 and sum(rows) == 8060 and max(rows) <= 4060


def test_compacting_shares_files_of_two_pieces_out(spark, tmp_path, schema_name):
    name, root = f"{schema_name}.c", str(tmp_path / "c")
    noise = F.sha2(F.col("id").cast("string"), 512).alias("v")
    folder = tables.replace_table(spark, name, spark.range(0, 33_000, 1, 33).select("id", noise), root)
    files, size = maintenance._size(spark, folder)
    assert files == 33  # a sixteenth of what is wanted is about half a file
    added = maintenance.compact_table(spark, name, root, size // 4 + 1)[0]
    rows = [r.n for r in spark.table(name).groupBy("_metadata.file_path").agg(F.count("*").alias("n")).collect()]
    # two tasks of the four read all row groups, as the second halves come after all first ones
    assert added == 4 and sum(rows) == 33_000 and max(rows) <= 10_000
    assert spark.table(name).agg(F.sum("id")).first()[0] == sum(range(33_000))


def test_compact_partitioned(spark, tmp_path, schema_name):
    name, root = f"{schema_name}.c", str(tmp_path / "c")
    small_files(spark, name, root, partition_by=["k"])
    added, removed, _ = maintenance.compact_table(spark, name, root)
    assert added < removed and tables.partition_columns(spark, name) == ["k"]
    assert spark.table(name).where("k = '1'").count() == 333 and spark.table(name).count() == 1000


def test_expire_only_old_replaced_versions(spark, tmp_path, schema_name):
    name, root = f"{schema_name}.e", str(tmp_path / "e")
    now = datetime.now(timezone.utc)
    old = tables.replace_table(spark, name, spark.range(3), root)
    current = tables.replace_table(spark, name, spark.range(2), root)
    spark.range(1).write.parquet(f"{root}/unknown")
    other = tables.replace_table(spark, f"{schema_name}.other", spark.range(9), root)
    # replaced just now: kept, however old the data may be
    assert maintenance.obsolete_versions(spark, name, root, 168) == []
    later = now + timedelta(hours=169)
    dry = maintenance.expire_versions(spark, name, root, 168, later, dry_run=True)
    assert dry.count() >= 1 and spark.read.parquet(old).count() == 3
    gone = maintenance.expire_versions(spark, name, root, 168, later)
    assert gone.count() == dry.count()  # one file counts as one
    assert not maintenance.path_exists(spark, old)
    for kept in (current, other, f"{root}/unknown"):
        assert maintenance.path_exists(spark, kept)
    assert spark.table(name).count() == 2
    assert maintenance.expire_versions(spark, name, root, 168, later).count() == 0
    assert maintenance.expire_versions(spark, name, str(tmp_path / "none")).count() == 0


def test_maintain_isolates_failures(spark, tmp_path, schema_name):
    small_files(spark, f"{schema_name}.good", str(tmp_path / "good"))
    schema = T.StructType([T.StructField("i", T.IntegerType())])
    tables.create_table_if_absent(spark, f"{schema_name}.bad", schema, str(tmp_path / "missing"))
    others = [d.name for d in spark.catalog.listDatabases() if d.name != schema_name]
    fs, path = maintenance.filesystem(spark, str(tmp_path / "missing"))
    fs.delete(path, True)
    report = {r.table.split(".")[-1]: r for r in maintenance.maintain(spark, excluded=others).collect()}
    assert report["good"].status == "ok" and report["good"].files_removed > report["good"].files_added
    assert report["bad"].status == "failed" and report["bad"].message
    names = list_tables(spark, excluded=others).select("table_name").collect()
    assert sorted(r.table_name for r in names) == ["bad", "good"]
    assert list_tables(spark, excluded=[*others, schema_name]).count() == 0


def test_maintain_deals_no_rows_out(spark, tmp_path, schema_name, monkeypatch):
    from plans import parquet_writes

    for table in ("a", "b"):
        small_files(spark, f"{schema_name}.{table}", str(tmp_path / table))
    others = [d.name for d in spark.catalog.listDatabases() if d.name != schema_name]
    seen = parquet_writes(monkeypatch)
    report = maintenance.maintain(spark, excluded=others).collect()
    assert [(r.status, r.files_added) for r in report] == [("ok", 1)] * 2 and all(r.files_removed >= 100 for r in report)
    assert [("Exchange" in plan, tasks) for plan, tasks in seen] == [(False, 1)] * 2
    assert [spark.table(f"{schema_name}.{t}").agg(F.sum("id")).first()[0] for t in "ab"] == [499_500] * 2


def test_widening_is_the_same_from_either_side():
    from tidemark.sinks.widening import merged_schema, wider_type

    cases = [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("bigint", "decimal(5,2)", "decimal(22,2)"),
        ("float", "int", "double"), ("bigint", "string", "string"), ("date", "timestamp", "timestamp"), ("boolean", "int", "string"),
        ("array<int>", "array<double>", "array<double>"), ("struct<a:int>", "struct<a:double,b:string>", "struct<a:double,b:string>"),
    ]
    for one, other, wide in cases:
        types = [T.StructType.fromDDL(f"x {t}")["x"].dataType for t in (one, other, wide)]
        assert wider_type(types[0], types[1]) == wider_type(types[1], types[0]) == types[2], (one, other)
    with pytest.raises(ValueError, match="a.b: struct<c:int> and int"):
        merged_schema(T.StructType.fromDDL("a struct<b:struct<c:int>>"), T.StructType.fromDDL("a struct<b:int>"))


def test_longs_beside_fractions_keep_their_digits(spark, tmp_path, schema_name):
    big = 9_007_199_254_740_993
    cases = {
        "small": ("SELECT 7L AS v", "SELECT 0.5D AS v", ["7.0", "0.5"], "double"),
        "long_first": (f"SELECT {big}L AS v", "SELECT 0.5D AS v", [str(big), "0.5"], "string"),
        "fraction_first": ("SELECT 0.5D AS v", f"SELECT -{big}L AS v", ["0.5", f"-{big}"], "string"),
        "nested": (f"SELECT named_struct('a', array({big}L, 1L)) AS v", "SELECT named_struct('a', array(0.5D)) AS v", [f"[{big}, 1]", "[0.5]"], "struct<a:array<string>>"),
    }
    for case, (one, other, values, kind) in cases.items():
        name, first = f"{schema_name}.{case}", spark.sql(one)
        tables.create_table_if_absent(spark, name, first.schema, str(tmp_path / case))
        tables.append_evolving(spark, name, first)
        tables.append_evolving(spark, name, spark.sql(other))
        got = spark.table(name)
        shown = got.select((F.col("v")["a"] if case == "nested" else F.col("v")).cast("string").alias("v"))
        assert sorted(r.v for r in shown.collect()) == sorted(values) and dict(got.dtypes)["v"] == kind, case


def test_append_never_narrows(spark, tmp_path, schema_name):
    name = f"{schema_name}.t"
    tables.create_table_if_absent(spark, name, T.StructType.fromDDL("v bigint, s struct<`content-type`: string>"), str(tmp_path / "it's"))
    tables.append_evolving(spark, name, spark.sql("SELECT 1L AS v, named_struct('content-type', 'a') AS s"))
    tables.append_evolving(spark, name, spark.sql("SELECT 2.75D AS v, named_struct('content-type', 'b', 'new', 5) AS s"))
    tables.append_evolving(spark, name, spark.sql("SELECT 'A7' AS v"))
    got = sorted((r.v, r.s and r.s["content-type"], r.s and r.s["new"]) for r in spark.table(name).collect())
    assert got == [("1.0", "a", None), ("2.75", "b", 5), ("A7", None, None)]


def test_first_location_expires_and_notes_stay(spark, tmp_path, schema_name):
    name, home = f"{schema_name}.t", str(tmp_path / "t")
    tables.create_table_if_absent(spark, name, T.StructType.fromDDL("id bigint"), home)
    for k in range(4):
        tables.append_evolving(spark, name, spark.range(k, k + 1))
    tables.set_table_note(spark, name, "mark", "7")
    root = tables.version_root(spark, name)
    assert maintenance.compact_table(spark, name, root)[1] >= 4
    assert maintenance.compact_table(spark, name, root) == (0, 0, 0)
    later = datetime.now(timezone.utc) + timedelta(hours=200)
    assert maintenance.expire_versions(spark, name, root, as_of=later).count() >= 4
    assert maintenance.expire_versions(spark, name, root, as_of=later).count() == 0
    assert spark.table(name).count() == 4 and tables.table_note(spark, name, "mark") == "7"
