from __future__ import annotations

import json
import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.config import (
    BronzeJob,
    ConfigError,
    LandingJob,
    MaintenanceJob,
    bronze_schema,
    render_path,
    short_name,
)
from tidemark import jobs
from tidemark.jobs import run_bronze, run_landing, run_maintenance
from tidemark.plans.feeds import READERS, Extract
from tidemark.shared import shared_folder
from tidemark.sinks.files import WriteMode

META = {"data_source": "src", "source_type": "files", "cost_center": "cc", "system_owner": "own"}


def test_names_and_paths():
    assert render_path("{origin}/{schema}/{table}", origin="o", schema="s", table="t", extra="x") == "o/s/t"
    with pytest.raises(ConfigError, match="table"):
        render_path("{table}")
    assert short_name("a.b.c") == "c" and short_name("c") == "c"
    assert bronze_schema("crm", "sales") == "crm_sales" and bronze_schema("crm", "crm_x") == "crm_x"


def test_catalog_engine_and_address_are_used():
    raw = {"catalog": "lake", "metadata": {}, "schemas": {"sales": {"dbo.orders": {}}}, "outputs": "/x", "db_name": "shop", "engine": "postgresql"}
    job = LandingJob.from_json(raw)
    assert job.bronze_name(job.tables[0]) == "lake.sales.orders"
    connection = jobs.job_connection(job, "h", 5432, "u", "p", fetch_rows=7)
    assert connection.options() == {"url": "jdbc:postgresql://h:5432/shop", "user": "u", "password": "p", "fetchsize": "7"}
    plain = LandingJob.from_json({**raw, "catalog": "spark_catalog", "engine": None})
    assert plain.bronze_name(plain.tables[0]) == "sales.orders"
    assert jobs.job_connection(plain, "h", 1, "u", "p").url.startswith("jdbc:mysql://h:1/shop")
    assert jobs.job_connection(plain, "h", 1, "u", "p", sqlserver_names=["shop"]).url.startswith("jdbc:sqlserver://h:1")
    bronze = BronzeJob.from_json({"input_path": "/i", "schemas": {"sales": {"orders": {}}}, "location": "/l", "checkpoints": "/c", "catalog": "lake"})
    assert bronze.bronze_name(bronze.tables[0]) == "lake.sales.orders"


def test_landing_config():
    text = json.dumps(
        {
            "catalog": "c", "metadata": META, "outputs": "{schema}/{table}", "data_source": "crm",
            "schemas": {"s": {"db.t": {"incremental_col": "ts", "incremental_where": "ts >"}, "u": {"incremental_col": "-"}}},
        }
    )
    job = LandingJob.from_json(text)
    t, u = job.tables
    assert t.has_mark and t.write_mode is WriteMode.APPEND and t.incremental_where == "ts >"
    assert not u.has_mark and u.write_mode is WriteMode.OVERWRITE
    assert job.bronze_name(t) == "c.crm_s.t" and job.engine is None and job.incremental
    with pytest.raises(ConfigError, match="outputs"):
        LandingJob.from_json({"catalog": "c", "metadata": {}, "schemas": {}})


def test_bronze_config_old_and_new():
    old = {"input_path": "i", "location": "l", "checkpoints": "c", "schemas": {"s": [{"t": "append"}, {"u": "overwrite"}]}}
    assert [s.mode for s in BronzeJob.from_json(old).tables] == [WriteMode.APPEND, WriteMode.OVERWRITE]
    new = {**old, "schemas": {"s": {"t": {"mode": ["append"], "file_format": "csv", "x": 1}}}}
    (spec,) = BronzeJob.from_json(new).tables
    assert spec.mode is WriteMode.APPEND and spec.file_format == "csv" and dict(spec.options) == {"x": 1}
    assert MaintenanceJob.from_json('{"retention_hours": "168", "catalogs": ["c"]}') == MaintenanceJob(168, ("c",))


class Lake:
    """A landing and a bronze job over one temporary lake."""

    def __init__(self, spark, root, reader, options, **settings):
        self.spark, self.root = spark, root
        self.bronze_options = settings.pop("bronze", {})
        self.landing_settings = settings
        self.spec = {"reader": reader, **options}
        self.tag = f"l{abs(hash(str(root))) % 10**9}"

    def run(self, as_of, **changes):
        base = {
            "catalog": "spark_catalog", "metadata": META, "data_source": "src", "source_type": "files",
            "outputs": f"{self.root}/landing/{{source_type}}/{{data_source}}/{{schema}}/{{table}}",
            "input": f"{self.root}/in", "schemas": {self.tag: {"t": self.spec}},
        }
        job = LandingJob.from_json({**base, **self.landing_settings, **changes})
        landed = run_landing(self.spark, job, as_of)[f"{self.tag}.t"]
        bronze = BronzeJob.from_json(
            {
                "input_path": base["outputs"], "location": f"{self.root}/bronze/{{schema}}/{{table}}",
                "checkpoints": f"{self.root}/checkpoints/{{schema}}/{{table}}", "data_source": "src", "source_type": "files",
                "schemas": {self.tag: {"t": {"mode": "append", "file_format": self.spec.get("file_format", "json"), **self.bronze_options}}},
            }
        )
        (name,) = run_bronze(self.spark, bronze) if landed else (job.bronze_name(job.tables[0]),)
        return landed, self.spark.table(name)


def write(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(content if isinstance(content, bytes) else content.encode())


def test_dated_files_by_mark(spark, tmp_path):
    lake = Lake(spark, tmp_path, "dated_files", {"prefix": "visits_", "mark_column": "_file_generation_date"})
    write(tmp_path / "in", "x_visits_20240130.csv", "a,b\né,1\n".encode("latin-1"))
    write(tmp_path / "in", "x_visits_20240131.csv", "a,b\né,2\nragged\n")
    landed, table = lake.run(datetime(2024, 1, 31, 8))
    assert landed and table.count() == 2 and {r._qtd_rows for r in table.collect()} == {2}
    write(tmp_path / "in", "x_visits_20240201.csv", "a,b\nx,3\n")
    landed, table = lake.run(datetime(2024, 2, 1, 8))
    assert sorted((r.a, r.b) for r in table.collect()) == [("x", "3"), ("é", "1"), ("é", "2")]
    assert {r._data_source for r in table.collect()} == {"src"}
    landed, table = lake.run(datetime(2024, 2, 1, 20))
    assert not landed and table.count() == 3


def test_zipped_files(spark, tmp_path):
    lake = Lake(spark, tmp_path, "zipped_files", {"prefix": "msg", "keyword": "reward", "mark_column": "_file_generation_date"})
    for day, value in (("30-01-2024", 1), ("01-02-2024", 2)):
        (tmp_path / "in").mkdir(exist_ok=True)
        with zipfile.ZipFile(tmp_path / "in" / f"{day}_x.zip", "w") as packed:
            packed.writestr("msg.csv", f"a b,c\n{value},x\n")
            packed.writestr("msg_reward.csv", "a b,c\n9,9\n")
        landed, table = lake.run(datetime.strptime(day, "%d-%m-%Y"))
        assert landed
    assert sorted(r.a_b for r in table.collect()) == ["1", "2"]


def test_reports_look_back_and_append_again(spark, tmp_path):
    options = {
        "time_column": "Start", "mark_column": "Start", "daily_extract": {"days": 2}, "time_intervals": 3,
        "file_format": "parquet", "zones": ["US/Pacific", "America/Sao_Paulo"],
    }
    lake = Lake(spark, tmp_path, "reports", options)
    rows = ["2024-01-28 10:00:00", "2024-01-30 10:00:00", "2024-01-31 09:00:00"]
    write(tmp_path / "in", "r.csv", "Call Id,Start\n" + "".join(f'"{n}, x",{t}\n' for n, t in enumerate(rows)))
    manual = {"incremental": False}
    lake.spec |= {"start_date": "2024-01-28T00:00:00.000-03:00", "end_date": "2024-01-31T00:00:00.000-03:00"}
    landed, table = lake.run(datetime(2024, 1, 31, 8), **manual)
    assert sorted(r.Call_Id for r in table.collect()) == ["0, x", "1, x"]
    assert table.first()._timezone_diff == 5 and table.first()._extraction_date == "2024-01-31 05:00:00"
    landed, table = lake.run(datetime(2024, 1, 31, 12), frequency="daily")
    # mark 30th, two days back: the 30th comes again, as an append
    assert sorted(r.Call_Id for r in table.collect()) == ["0, x", "1, x", "1, x", "2, x"]


def test_reports_without_a_mark_are_taken_whole(spark, tmp_path):
    def copies():
        return set(Path(shared_folder(spark)).glob("tidemark/extract-*"))

    lake = Lake(spark, tmp_path, "reports", {"time_column": "Start", "mark_column": "Start"})
    write(tmp_path / "in", "r.csv", "Id,Start\n1,2020-01-01 00:00:00\n2,bad time\n")
    before = copies()
    assert lake.run(datetime(2024, 1, 31, 8))[1].count() == 2
    assert copies() == before  # the settled copy is gone


def test_plain_documents_of_yesterday(spark, tmp_path):
    lake = Lake(spark, tmp_path, "plain_documents", {"mark_column": "createdAt", "file_format": "csv", "fields": ["id", "createdAt", "dateOfCreation"], "drop": ["dateOfCreation"]})
    docs = [("a", "31-01-2024 00:00:00"), ("a", "31-01-2024 00:00:00"), ("b", "31-01-2024 23:59:59"), ("c", "01-02-2024 00:00:00")]
    write(tmp_path / "in", "d.json", "".join(json.dumps({"id": i, "createdAt": t, "dateOfCreation": "z"}) + "\n" for i, t in docs))
    _, table = lake.run(datetime(2024, 2, 1, 5))
    assert sorted(r.id for r in table.collect()) == ["a", "b"]
    assert "dateOfCreation" not in table.columns


def test_typed_documents_of_yesterday_in_a_zone(spark, tmp_path):
    lake = Lake(spark, tmp_path, "typed_documents", {"mark_column": "createdAt", "file_format": "csv", "id_column": "sessions_id", "zone": "America/Sao_Paulo"})
    lines = []
    for key, at in (("in", "2024-02-01T02:59:59.999Z"), ("out", "2024-02-01T03:00:00Z"), ("first", "2024-01-31T00:00:00-03:00")):
        document = {"name": f"x/y/{key}", "fields": {"createdAt": {"stringValue": at}, "n": {"integerValue": "1"}}}
        lines.append(json.dumps({"document": document}))
    write(tmp_path / "in", "d.json", "\n".join(lines))
    _, table = lake.run(datetime(2024, 2, 1, 5))
    assert sorted((r.sessions_id, r.createdAt) for r in table.collect()) == [
        ("first", "2024-01-31T00:00:00"), ("in", "2024-02-01T02:59:59"),
    ]


def test_store_reports_replace_the_table(spark, tmp_path):
    lake = Lake(spark, tmp_path, "store_reports", {"suffix": "_overview.csv", "file_format": "csv", "variants": {"Package Name": "Package name"}}, bronze={"clean_names": True})
    mark = b"\xff\xfe"
    write(tmp_path / "in", "a_overview.csv", mark + "Package Name,Daily (avg)\np,1\n".encode("utf-16-le"))
    write(tmp_path / "in", "b_overview.csv", mark + "Package name,Other\nq,2\n".encode("utf-16-le"))
    write(tmp_path / "in", "c_ratings.csv", mark + "Else\nz\n".encode("utf-16-le"))
    for _ in range(2):
        _, table = lake.run(datetime(2024, 2, 1))
    got = {(r.Package_name, r.Daily_avg, r.Other) for r in table.collect()}
    assert got == {("p", "1", None), ("q", None, "2")} and table.count() == 2
    assert "data_source" in table.columns and "_metadata" in table.columns


def test_warehouse_view_daily_and_hourly(spark, tmp_path):
    rows = [(n, datetime(2024, 1, 28 + n, 6)) for n in range(4)]
    spark.createDataFrame(rows, "n int, ts timestamp_ntz").write.parquet(str(tmp_path / "in"))
    lake = Lake(spark, tmp_path, "warehouse_view", {"mark_column": "ts", "file_format": "parquet"})
    _, table = lake.run(datetime(2024, 1, 29, 1), frequency="daily")
    assert table.count() == 4  # first run: everything
    landed, _ = lake.run(datetime(2024, 1, 29, 9), frequency="daily")
    assert not landed or table.count() >= 4


def test_mark_is_kept_with_the_table(spark, tmp_path, schema_name):
    from tidemark.jobs import table_mark
    from tidemark.sinks.tables import append_evolving, create_table_if_absent, replace_table, table_note

    name, root = f"{schema_name}.t", str(tmp_path / "t")
    job = LandingJob.from_json(
        {"catalog": "spark_catalog", "metadata": META, "outputs": "o", "schemas": {schema_name: {"t": {"mark_column": "ts"}}}}
    )

    def mark():
        return table_mark(spark, job, job.tables[0], datetime(2024, 6, 1))

    def rows(*days):
        return spark.createDataFrame([(datetime(2024, 1, d),) for d in days], "ts timestamp_ntz")

    assert mark() is None
    create_table_if_absent(spark, name, rows(1).schema, root)
    assert mark() is None and table_note(spark, name, "mark.ts") is None
    append_evolving(spark, name, rows(3, 1))
    assert mark() == datetime(2024, 1, 3) and table_note(spark, name, "mark.ts") == "2024-01-03T00:00:00"
    append_evolving(spark, name, rows(9))
    assert mark() == datetime(2024, 1, 9)
    replace_table(spark, name, rows(2), root + "-versions")  # the mark goes back with the data
    assert mark() == datetime(2024, 1, 2)


def test_text_mark_is_kept_by_the_loads(spark, tmp_path, schema_name, monkeypatch):
    from tidemark.jobs import table_mark
    from tidemark.sinks import kept_marks
    from tidemark.sinks.files import write_files
    from tidemark.sinks.tables import append_evolving, replace_partitions
    from tidemark.streaming.load import LOAD_BATCH, copy_into

    name, reads = f"{schema_name}.t", []
    job = LandingJob.from_json(
        {"catalog": "spark_catalog", "metadata": META, "outputs": "o", "schemas": {schema_name: {"t": {"mark_column": "ts"}}}}
    )
    measures = kept_marks._measures

    def mark(as_of=datetime(2024, 6, 1)):
        reads.clear()
        with monkeypatch.context() as patch:
            patch.setattr(kept_marks, "_measures", lambda *a: (reads.append(a), measures(*a))[1])
            found = table_mark(spark, job, job.tables[0], as_of)
        everything = [datetime.fromisoformat(r.ts) for r in spark.table(name).collect() if r.ts and r.ts[0] == "2"]
        assert found == max((v for v in everything if v <= as_of), default=None)
        return found, len(reads)

    def load(*texts, columns="ts string"):
        write_files(spark.createDataFrame([(t,) for t in texts], columns), str(tmp_path / "in"))
        copy_into(spark, name, str(tmp_path / "t"), str(tmp_path / "in"), str(tmp_path / "c"))

    load("2024-01-03", "no time", None)
    assert mark() == (datetime(2024, 1, 3), 1)  # the first lookup reads
    assert mark() == (datetime(2024, 1, 3), 0)
    load("2024-01-05T06:00:00.5", "2024-01-02")
    assert mark() == (datetime(2024, 1, 5, 6, 0, 0, 500_000), 0)
    load("x", columns="other string")  # without the column
    assert mark()[1] == 0
    load("2124-01-01", "2124-03-01")  # ahead of its time: not the mark, and no reading either
    assert mark() == (datetime(2024, 1, 5, 6, 0, 0, 500_000), 0)
    assert mark(datetime(2124, 2, 1)) == (datetime(2124, 1, 1), 1)  # between two kept values
    assert mark(datetime(2024, 1, 4)) == (datetime(2024, 1, 3), 1)
    mark()
    # other writers make what is kept void
    append_evolving(spark, name, spark.createDataFrame([("2024-02-01", "by hand")], f"ts string, {LOAD_BATCH} string"))
    assert mark() == (datetime(2024, 2, 1), 1)
    replace_partitions(spark, name, spark.createDataFrame([("2024-01-09", "by hand")], f"ts string, {LOAD_BATCH} string"))
    assert mark() == (datetime(2024, 1, 9), 1) and mark()[1] == 0


def test_a_write_during_the_lookup_voids_its_mark(spark, tmp_path, schema_name, monkeypatch):
    from tidemark.sinks import kept_marks
    from tidemark.sinks.tables import append_evolving, create_table_if_absent

    name, at = f"{schema_name}.t", datetime(2024, 6, 1)
    rows = lambda *days: spark.createDataFrame([(f"2024-01-{d:02}",) for d in days], "ts string")
    create_table_if_absent(spark, name, rows(1).schema, str(tmp_path / "t"))
    append_evolving(spark, name, rows(1))
    keep = kept_marks._keep
    with monkeypatch.context() as patch:
        patch.setattr(kept_marks, "_keep", lambda *a: (append_evolving(spark, name, rows(7)), keep(*a)))
        assert kept_marks.text_mark(spark, name, "ts", None, at) == datetime(2024, 1, 1)
    assert kept_marks.text_mark(spark, name, "ts", None, at) == datetime(2024, 1, 7)


def test_warehouse_windows(spark, tmp_path):
    rows = [(n, datetime(2024, 1, 28 + n, 6)) for n in range(4)]
    spark.createDataFrame(rows, "n int, ts timestamp_ntz").write.parquet(str(tmp_path / "in"))

    def extract(mark, as_of, as_text=False, **changes):
        about = {"mark_column": "ts", "reader": "warehouse_view", "as_text": as_text}
        about |= {k: changes.pop(k) for k in ("start_date", "end_date") if k in changes}
        job = LandingJob.from_json(
            {"catalog": "c", "metadata": META, "outputs": "o", "input": str(tmp_path / "in"), "schemas": {"s": {"t": about}}, **changes}
        )
        return READERS["warehouse_view"](Extract(spark, job, job.tables[0], as_of, mark))

    mark = datetime(2024, 1, 28, 7)
    assert sorted(r.n for r in extract(mark, datetime(2024, 1, 31, 1)).collect()) == [1, 2]
    assert extract(mark, datetime(2024, 1, 29, 1)).count() == 0  # up to date
    assert sorted(r.n for r in extract(mark, datetime(2024, 1, 31, 1), frequency="hourly").collect()) == [1, 2, 3]
    manual = extract(None, mark, incremental=False, start_date="2024-01-29", end_date="2024-01-30", as_text=True)
    assert [r.n for r in manual.collect()] == ["1"]


def test_database_extract_needs_a_connection(spark):
    job = LandingJob.from_json({"catalog": "c", "metadata": META, "outputs": "o", "schemas": {"s": {"t": {}}}})
    with pytest.raises(ConfigError, match="connection"):
        READERS["database"](Extract(spark, job, job.tables[0], datetime(2024, 1, 1)))


def test_database_conditions(spark, monkeypatch):
    from tidemark.plans import feeds
    from tidemark.sources.databases import Connection

    seen = []
    monkeypatch.setattr(feeds, "read_filtered", lambda *a: seen.append(a[2:]) or spark.range(1))
    job = LandingJob.from_json(
        {"catalog": "c", "metadata": META, "outputs": "o",
         "schemas": {"s": {"t": {"mark_column": "ts", "incremental_where": "ts >"}, "u": {"full_where": "x = 1"}, "v": {}}}}
    )
    connection = Connection("jdbc:x", "u", "p")
    for spec in job.tables:
        for mark in (None, datetime(2024, 1, 2)):
            READERS["database"](Extract(spark, job, spec, datetime(2024, 1, 3), mark, connection))
    assert [s[:2] for s in seen] == [
        ("s.t", None), ("s.t", "ts > '2024-01-02 00:00:00'"), ("s.u", "x = 1"), ("s.u", "x = 1"), ("s.v", None), ("s.v", None),
    ]


def test_run_maintenance(spark):
    report = run_maintenance(spark, MaintenanceJob(168, ("spark_catalog",)))
    assert report.where(F.col("status").isin("ok", "failed")).count() == report.count()
