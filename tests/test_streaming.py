from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import folding
from tidemark.functions.payload import all_string_schema
from tidemark.jobs import land_queue, load_queue
from tidemark.operators.ledger import ledger_entries, read_ledger, unread_paths
from tidemark.retry import retry
from tidemark.sinks.files import write_files
from tidemark.maintenance import compact_table, expire_versions
from tidemark.sinks.tables import replace_partitions
from tidemark.streaming.load import LOAD_BATCH, copy_into, set_aside
from tidemark.streaming.messages import accepted, drain_messages, rejected
from workload.streams import EVENT_SCHEMA, MESSAGE_SCHEMA, crash_after_first_write

AT = datetime(2024, 1, 31, 6, 15)


@pytest.fixture
def places(tmp_path):
    return {k: str(tmp_path / k) for k in ("landing", "table", "checkpoint", "source", "ledger")}


def numbers(spark, start, stop):
    return spark.range(start, stop).select(F.col("id").alias("event_id"))


def load(spark, name, p, **options):
    return copy_into(spark, name, p["table"], p["source"], p["checkpoint"], **options)


def test_each_file_once(spark, places, schema_name):
    name = f"{schema_name}.t"
    write_files(numbers(spark, 0, 10), places["source"])
    assert load(spark, name, places, schema=EVENT_SCHEMA).rows == 10
    assert load(spark, name, places, schema=EVENT_SCHEMA).rows == 0
    write_files(numbers(spark, 10, 13), places["source"])
    assert load(spark, name, places, schema=EVENT_SCHEMA).rows == 3
    got = spark.table(name)
    assert got.agg(F.count("*"), F.countDistinct("event_id"), F.countDistinct(LOAD_BATCH)).first() == (13, 13, 2)
    assert got.where(F.col("_metadata.file_name").isNull()).count() == 0


def test_many_micro_batches(spark, places, schema_name):
    for n in range(5):
        write_files(numbers(spark, n, n + 1).coalesce(1), places["source"])
    result = load(spark, f"{schema_name}.t", places, schema=EVENT_SCHEMA, max_files=2)
    assert result.rows == 5 and result.batches >= 3
    assert spark.table(f"{schema_name}.t").count() == 5


def test_crash_between_write_and_commit(spark, places, schema_name):
    name = f"{schema_name}.t"
    write_files(numbers(spark, 0, 10), places["source"])
    crash_after_first_write(spark, name, places["table"], places["source"], places["checkpoint"])
    assert spark.table(name).count() == 10
    load(spark, name, places, schema=EVENT_SCHEMA)
    assert spark.table(name).count() == 10


def test_a_new_checkpoint_does_not_overwrite(spark, places, schema_name):
    name = f"{schema_name}.t"
    write_files(numbers(spark, 0, 4), places["source"])
    load(spark, name, places, schema=EVENT_SCHEMA)
    load(spark, name, {**places, "checkpoint": places["checkpoint"] + "2"}, schema=EVENT_SCHEMA)
    assert spark.table(name).count() == 8


def test_no_files_yet_still_makes_the_table(spark, places, schema_name):
    name = f"{schema_name}.t"
    write_files(numbers(spark, 0, 0), places["source"], "parquet")
    assert load(spark, name, places, file_format="parquet", schema=EVENT_SCHEMA).rows == 0
    assert spark.table(name).count() == 0
    write_files(numbers(spark, 0, 2), places["source"], "parquet")
    load(spark, name, places, file_format="parquet", schema=EVENT_SCHEMA)
    assert spark.table(name).count() == 2


def test_discovery_reads_no_contents(spark, places, schema_name):
    write_files(numbers(spark, 0, 10), places["source"])
    setting = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")  # any file's content would be too long
    try:
        assert load(spark, f"{schema_name}.t", places, schema=EVENT_SCHEMA).rows == 10
    finally:
        spark.conf.set(setting, before)


def test_columns_are_inferred_from_new_files_only(spark, places, schema_name):
    name = f"{schema_name}.t"
    write_files(numbers(spark, 0, 3), places["source"])
    load(spark, name, places)
    old = spark.table(name).select("_metadata.file_path").distinct().collect()
    from tidemark.shared import filesystem

    for row in old:  # an archived file must not be missed
        fs, path = filesystem(spark, row.file_path)
        fs.delete(path, True)
    write_files(numbers(spark, 3, 5).withColumn("more", F.lit(True)), places["source"])
    assert load(spark, name, places).rows == 2
    assert sorted((r.event_id, r.more) for r in spark.table(name).collect()) == [
        (0, None), (1, None), (2, None), (3, True), (4, True),
    ]


def write_text(spark, folder, *files):
    for lines in files:
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(folder)


def test_csv_files_are_read_under_their_own_headers(spark, places, schema_name):
    name = f"{schema_name}.t"
    write_text(spark, places["source"], ["a,b", "1,2", '"x,y",'], ["B,A", "3,4", "", "B,A"], ["a,c c,", '5,"q""r",7'])
    assert load(spark, name, places, file_format="csv").rows == 5
    got = spark.table(name)
    assert {c.lower() for c in got.columns} == {"a", "b", "c c", "_c2", "_metadata", LOAD_BATCH}
    rows = {tuple(r) for r in got.select("a", "b", "c c", "_c2").collect()}
    assert rows == {("1", "2", None, None), ("4", "3", None, None), ("5", None, 'q"r', "7"), ("A", "B", None, None), ("x,y", None, None, None)}


def test_csv_with_declared_columns_rescues_and_sets_aside(spark, places, schema_name):
    name, schema = f"{schema_name}.t", T.StructType.fromDDL("id bigint, v double")
    write_text(spark, places["source"], ["id,v,more", "1,0.5,x", "2,oops,y", "3,1.5", ",,"], ["v,id", "2.5,4", "1,2,3", "9e3,5"])
    result = load(spark, name, places, file_format="csv", schema=schema)
    assert (result.rows, result.set_aside) == (5, 2)
    assert sorted((r.id or 0, r.v, r._rescued) for r in spark.table(name).collect()) == [
        (0, None, None), (1, 0.5, '{"more":"x"}'), (3, 1.5, None), (4, 2.5, None), (5, 9000.0, None),
    ]
    assert sorted(r.line for r in set_aside(spark, name).collect()) == ["1,2,3", "2,oops,y"]


def test_csv_with_line_breaks_and_two_headers(spark, places, schema_name):
    name = f"{schema_name}.t"
    write_text(spark, places["source"], ['a,b\n1,"x\ny"'], ['b,a\n"p\n\nq",2'])
    assert load(spark, name, places, file_format="csv", multi_line=True).rows == 2
    assert sorted((r.a, r.b) for r in spark.table(name).collect()) == [("1", "x\ny"), ("2", "p\n\nq")]


def test_broken_lines_are_set_aside_with_and_without_columns(spark, places, schema_name):
    lines = ['{"event_id": 1}', '{"event_id": 2', '{"event_id": 3, "value": 0.5}', '{"event_id": "four"}']
    write_text(spark, places["source"], lines)
    declared, inferred = f"{schema_name}.declared", f"{schema_name}.inferred"
    result = load(spark, declared, places, schema=EVENT_SCHEMA)
    assert (result.rows, result.set_aside) == (2, 2)
    assert sorted(r.event_id for r in spark.table(declared).collect()) == [1, 3]
    assert sorted((r.line, r.reason) for r in set_aside(spark, declared).collect()) == [(lines[3], "broken line"), (lines[1], "broken line")]
    copy_into(spark, inferred, places["table"] + "2", places["source"], places["checkpoint"] + "2")
    assert sorted(r.event_id for r in spark.table(inferred).collect()) == ["1", "3", "four"]
    assert [r.line for r in set_aside(spark, inferred).collect()] == [lines[1]]
    # a replay replaces what it set aside
    load(spark, declared, {**places, "checkpoint": places["checkpoint"] + "3"}, schema=EVENT_SCHEMA)
    assert set_aside(spark, declared).count() == 4


def test_bad_files_do_not_block_the_good_ones(spark, places, schema_name):
    name = f"{schema_name}.t"
    write_files(numbers(spark, 0, 8).repartition(4), places["source"], "parquet")
    write_text(spark, places["source"], ["no parquet"])
    result = load(spark, name, places, file_format="parquet")
    assert (result.files, result.rows, result.bad_files) == (5, 8, 1)
    (bad,) = set_aside(spark, name).collect()
    assert bad.line is None and "footer" in bad.reason and bad.path.endswith(".txt")
    write_files(numbers(spark, 8, 9).select(F.struct("event_id").alias("event_id")).coalesce(1), places["source"], "parquet")
    write_files(numbers(spark, 9, 12), places["source"], "parquet")
    assert load(spark, name, places, file_format="parquet").bad_files == 1
    assert sorted(r.event_id for r in spark.table(name).collect()) == [*range(8), 9, 10, 11]


def test_a_fault_of_the_store_is_no_files_fault(spark, places, schema_name, monkeypatch):
    name = f"{schema_name}.t"
    write_files(numbers(spark, 0, 3), places["source"])

    def down(*args):
        raise OSError("store is down")

    monkeypatch.setattr("tidemark.streaming.load._json_rows", down)
    with pytest.raises(Exception, match="store is down"):
        load(spark, name, places, schema=EVENT_SCHEMA)
    monkeypatch.undo()
    assert load(spark, name, places, schema=EVENT_SCHEMA).rows == 3
    assert set_aside(spark, name).count() == 0


def many_loads(spark, name, places, n, first=0):
    for k in range(first, first + n):
        write_files(numbers(spark, k, k + 1).coalesce(1), places["source"], "parquet")
        load(spark, name, places, file_format="parquet", schema=EVENT_SCHEMA)


def labels(spark, name):
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def test_folding_and_replays(spark, places, schema_name):
    name = f"{schema_name}.t"
    many_loads(spark, name, places, 6)
    last = max(labels(spark, name))
    added, removed, size = compact_table(spark, name, "")
    assert (added, removed) == (1, 5) and size > 0
    assert compact_table(spark, name, "") == (0, 0, 0)
    assert last in labels(spark, name) and len(labels(spark, name)) == 2
    # the last batch is loaded again, as after a crash before its checkpoint
    copy = spark.table(name).where(F.concat(F.lit(f"{LOAD_BATCH}="), F.col(LOAD_BATCH)) == last)
    replace_partitions(spark, name, spark.createDataFrame(copy.collect(), copy.schema))
    many_loads(spark, name, places, 3, first=6)
    assert compact_table(spark, name, "")[1] == 4  # the fold is small itself, so it grows
    assert sorted(r.event_id for r in spark.table(name).collect()) == list(range(9))
    gone = expire_versions(spark, name, places["table"] + ".none", as_of=datetime.now(timezone.utc) + timedelta(hours=200))
    assert gone.count() >= 8
    assert sorted(r.event_id for r in spark.table(name).collect()) == list(range(9))
    evolve = spark.sql("SELECT 99L AS event_id, named_struct('a', 1) AS deep, 'x-00000000' AS _load_batch")
    replace_partitions(spark, name, evolve)
    wider = spark.sql("SELECT 100L AS event_id, named_struct('a', 1, 'b', 2) AS deep, 'x-00000001' AS _load_batch")
    replace_partitions(spark, name, wider)  # the catalog entry is made anew: folded folders must not come back
    assert sorted(r.event_id for r in spark.table(name).collect()) == [*range(9), 99, 100]


def test_a_fold_that_broke_off_is_finished(spark, places, schema_name, monkeypatch):
    name = f"{schema_name}.t"
    many_loads(spark, name, places, 4)

    def crash(*args):
        raise RuntimeError("crash before the swap")

    monkeypatch.setattr(folding, "_swap", crash)
    with pytest.raises(RuntimeError, match="before the swap"):
        compact_table(spark, name, "")
    assert spark.table(name).count() == 4
    monkeypatch.undo()
    before = labels(spark, name)
    many_loads(spark, name, places, 1, first=4)
    assert sorted(r.event_id for r in spark.table(name).collect()) == list(range(5))
    assert len(labels(spark, name)) == 3 and not before <= labels(spark, name)


def test_folds_are_written_as_they_are_read(spark, places, schema_name, monkeypatch):
    from plans import parquet_writes

    name = f"{schema_name}.t"
    many_loads(spark, name, places, 7)
    one = max(r["size"] for r in folding.partition_files(spark, name).collect())
    before = {r.event_id: r["_metadata"] for r in spark.table(name).collect()}
    keys = ("files.maxPartitionBytes", "files.openCostInBytes", "maxConcurrentOutputFileWriters", "unionOutputPartitioning")
    settings = {f"spark.sql.{k}": spark.conf.get(f"spark.sql.{k}", None) for k in keys}
    seen = parquet_writes(monkeypatch)
    folding.fold_batches(spark, name, 3 * one + one // 2)
    written = [(plan, tasks) for plan, tasks in seen if "Union" in plan]
    # a task for each file; rows dealt out by fold were all held and sorted by the one task of a bin
    assert [tasks for _, tasks in written] == [2] and "Exchange" not in written[0][0] and "Sort" not in written[0][0]
    assert {r.event_id: r["_metadata"] for r in spark.table(name).collect()} == before and len(before) == 7
    assert {r.files for r in folding.partition_files(spark, name).collect()} == {1}
    assert settings == {k: spark.conf.get(k, None) for k in settings}


def test_a_large_partition_is_folded_into_several_files(spark, places, schema_name, monkeypatch):
    from plans import parquet_writes

    name = f"{schema_name}.t"
    many_loads(spark, name, places, 2)
    label = min(labels(spark, name)).split("=")[1]
    replace_partitions(spark, name, spark.range(10, 410, 1, 40).select(F.col("id").alias("event_id"), F.lit(label).alias(LOAD_BATCH)))
    found = {r.label: r for r in folding.partition_files(spark, name).collect()}[label]
    assert found.files == 40
    seen = parquet_writes(monkeypatch)
    assert folding.fold_batches(spark, name, found["size"] // 4 + 1)[1] >= 40
    plan, tasks = next(w for w in seen if "Coalesce" in w[0] and "event_id" in w[0])
    assert tasks == 4 and "Exchange" not in plan
    assert spark.table(name).agg(F.count("*"), F.sum("event_id")).first() == (401, sum(range(10, 410)) + 1)


def test_a_fold_shares_files_of_two_pieces_out(spark, places, schema_name):
    name = f"{schema_name}.t"
    many_loads(spark, name, places, 2)
    label = min(labels(spark, name)).split("=")[1]
    noise = F.sha2(F.col("id").cast("string"), 512).alias("v")
    rows = spark.range(10, 33_010, 1, 33).select(F.col("id").alias("event_id"), noise, F.lit(label).alias(LOAD_BATCH))
    replace_partitions(spark, name, rows)
    found = {r.label: r for r in folding.partition_files(spark, name).collect()}[label]
    assert found.files == 33  # a sixteenth of what is wanted is about half a file
    folding.fold_batches(spark, name, found["size"] // 4 + 1)
    files = spark.table(name).where(F.startswith(LOAD_BATCH, F.lit(folding.FOLD_PREFIX))).groupBy(F.input_file_name())
    counts = [r.n for r in files.agg(F.count("*").alias("n")).collect()]
    assert len(counts) == 4 and sum(counts) == 33_000 and max(counts) <= 10_000


def test_plan_of_folds():
    small = [folding.Small(f"s-{k:02d}", 1, size) for k, size in enumerate([40, 40, 40, 10, 90, 5])]
    assert [[p.size for p in b] for b in folding.plan_folds(small, 100)] == [[40, 40], [40, 10], [90, 5]]
    assert folding.plan_folds([folding.Small("a", 1, 40)], 100) == []
    assert folding.plan_folds([folding.Small("a", 9, 140)], 100) != []
    assert folding.plan_folds([], 100) == []


def test_schema_grows_between_runs(spark, places, schema_name):
    name = f"{schema_name}.t"
    write_files(numbers(spark, 0, 2), places["source"], "csv")
    load(spark, name, places, file_format="csv")
    assert set(spark.table(name).columns) == {"event_id", "_metadata", LOAD_BATCH}
    write_files(numbers(spark, 2, 4).withColumn("more", F.lit("x")), places["source"] + "/new", "parquet")
    load(spark, name, {**places, "source": places["source"] + "/new", "checkpoint": places["checkpoint"] + "2"}, file_format="parquet")
    got = spark.table(name).select("event_id", "more").collect()
    assert sorted((r.event_id, r.more) for r in got) == [("0", None), ("1", None), ("2", "x"), ("3", "x")]


def messages(spark, *bodies, first=0):
    rows = [(f"m{first + n}", "h", body, "r", "{}", 0) for n, body in enumerate(bodies)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def drain(spark, p, **options):
    return drain_messages(spark, p["source"], p["landing"], p["checkpoint"], MESSAGE_SCHEMA, **options)


def test_bad_bodies_are_set_aside_row_by_row(spark, places):
    write_files(messages(spark, '{"a": 1}', "bad", "worse", '{"a":  2}', "", '{"a": 3} x'), places["source"])
    result = drain(spark, places)
    assert (result.received, result.saved, result.rejected, result.stopped) == (6, 2, 4, "low_throughput")
    assert sorted(r.Body for r in accepted(spark, result.paths).collect()) == ['{"a":1}', '{"a":2}']
    assert sorted(r.Body for r in rejected(spark, result.paths).collect()) == ["", "bad", "worse", '{"a": 3} x']
    assert drain(spark, places).stopped == "zero_messages"


def test_two_flushes_in_one_minute_both_stay(spark, places):
    for n in range(2):
        write_files(messages(spark, '{"a": 1}', first=n), places["source"])
    result = drain(spark, places, max_files=1)
    assert result.saved == 2 and len(set(result.paths)) == 2
    assert accepted(spark, result.paths).count() == 2


def test_flush_size_bounds_files(spark, places):
    write_files(messages(spark, *['{"a": 1}'] * 25).coalesce(1), places["source"])
    result = drain(spark, places, flush_rows=10)
    per_file = accepted(spark, result.paths).groupBy("_metadata.file_name").count()
    assert per_file.agg(F.max("count"), F.sum("count")).first() == (10, 25)


def test_queue_to_bronze(spark, places, schema_name):
    name, body = f"{schema_name}.users", all_string_schema(["nome", "login"])

    def land():
        return land_queue(
            spark, places["source"], places["landing"], places["checkpoint"], places["ledger"], "users", "prd", MESSAGE_SCHEMA, AT
        )

    def to_bronze():
        return load_queue(spark, places["ledger"], "users", "prd", name, places["table"], body, AT)

    write_files(messages(spark, '{"nome": "a", "login": 1}', "bad"), places["source"])
    first = land()
    assert to_bronze() == list(first.paths) and to_bronze() == []
    write_files(messages(spark, '{"nome": "b"}', first=2), places["source"])
    land()
    to_bronze()
    got = spark.table(name)
    assert got.columns == ["nome", "login", "HTTPHeaders", "RetryAttempts", "MessageId", "RequestId", LOAD_BATCH]
    assert sorted((r.MessageId, r.nome, r.login) for r in got.collect()) == [("m0", "a", "1"), ("m2", "b", None)]


def test_reload_before_the_mark_leaves_no_duplicates(spark, places, schema_name, monkeypatch):
    from tidemark.streaming import messages as module

    name, body = f"{schema_name}.u", all_string_schema(["nome"])
    write_files(messages(spark, '{"nome": "a"}'), places["source"])
    land_queue(spark, places["source"], places["landing"], places["checkpoint"], places["ledger"], "u", "prd", MESSAGE_SCHEMA, AT)
    args = (spark, places["ledger"], "u", "prd", name, places["table"], body, AT)
    with monkeypatch.context() as patch:
        patch.setattr(module, "append_paths", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load_queue(*args)
    assert spark.table(name).count() == 1
    assert len(load_queue(*args)) == 1
    assert spark.table(name).count() == 1


def test_folders_load_group_by_group(spark, places, schema_name, monkeypatch):
    from tidemark.streaming import messages as module

    name, body, groups = f"{schema_name}.u", all_string_schema(["nome"]), []
    for n in range(3):
        write_files(messages(spark, f'{{"nome": "n{n}"}}', first=n), places["source"])
        land_queue(spark, places["source"], places["landing"], places["checkpoint"], places["ledger"], "u", "prd", MESSAGE_SCHEMA, AT)
    load = module._load_folders
    monkeypatch.setattr(module, "_load_folders", lambda s, paths, *a: (groups.append(len(paths)), load(s, paths, *a)))
    args = (spark, places["ledger"], "u", "prd", name, places["table"], body, AT)
    assert len(load_queue(*args, max_folders=2)) == 3 and groups == [2, 1]
    assert sorted(r.nome for r in spark.table(name).collect()) == ["n0", "n1", "n2"]
    assert load_queue(*args, max_folders=2) == []


def test_ledger_failure_stops_before_the_commit(spark, places, monkeypatch):
    from tidemark import jobs

    write_files(messages(spark, '{"nome": "a"}'), places["source"])
    args = (spark, places["source"], places["landing"], places["checkpoint"], places["ledger"], "u", "prd", MESSAGE_SCHEMA, AT)
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "append_paths", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            land_queue(*args, tries=1)
    again = land_queue(*args)
    unread = unread_paths(ledger_entries(read_ledger(spark, places["ledger"]), "u", "prd"))
    assert [r.path for r in unread.collect()] == list(again.paths)


def test_retry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return "done"

    pauses = []
    assert retry(flaky, 5, 7, pauses.append) == "done" and pauses == [7, 7]
    calls.clear()
    with pytest.raises(OSError):
        retry(flaky, 2, 0, pauses.append)
    with pytest.raises(ValueError):
        retry(flaky, 0)


def test_declared_schema_is_all_text():
    schema = all_string_schema(["a", "b"])
    assert all(isinstance(f.dataType, T.StringType) and f.nullable for f in schema)


# --- stopping and redelivery -----------------------------------------------------


def test_watched_drain_stops_at_low_throughput(spark, places):
    from tidemark.streaming import messages as module

    more = lambda n: write_files(messages(spark, *['{"a": 1}'] * n).coalesce(1), places["source"])
    more(8)
    waves, landed = [8, 2], []

    def another_wave(folder):
        landed.append(folder)
        if len(landed) == 1:
            more(2)

    result = module.drain_messages(
        spark, places["source"], places["landing"], places["checkpoint"], MESSAGE_SCHEMA,
        cycle="1 second", few=5, max_seconds=120, on_landed=another_wave,
    )
    assert (result.received, result.stopped, len(result.paths)) == (sum(waves), "low_throughput", 2)
    assert landed == list(result.paths)
    again = module.drain_messages(
        spark, places["source"], places["landing"], places["checkpoint"], MESSAGE_SCHEMA, cycle="1 second", few=5, max_seconds=120
    )
    assert (again.received, again.stopped, again.paths) == (0, "zero_messages", ())


def test_watched_drain_ends_when_its_time_is_up(spark, places):
    write_files(messages(spark, *['{"a": 1}'] * 8), places["source"])
    result = drain_messages(
        spark, places["source"], places["landing"], places["checkpoint"], MESSAGE_SCHEMA,
        cycle="1 hour", few=1, max_seconds=20,
    )
    assert (result.received, result.stopped) == (8, "time_limit")


def test_watched_drain_raises_what_its_query_raises(spark, places):
    write_files(messages(spark, '{"a": 1}'), places["source"])

    def fail(folder):
        raise RuntimeError("no ledger")

    with pytest.raises(Exception, match="no ledger"):
        drain_messages(
            spark, places["source"], places["landing"], places["checkpoint"], MESSAGE_SCHEMA,
            cycle="1 second", max_seconds=120, on_landed=fail,
        )


def test_redelivered_messages_land_once(spark, places):
    def run():
        return drain_messages(
            spark, places["source"], places["landing"], places["checkpoint"], MESSAGE_SCHEMA, once_by="MessageId", within="1 day"
        )

    ids = lambda result: sorted(r.MessageId for r in accepted(spark, result.paths).collect())
    first = messages(spark, '{"a": 1}', '{"a": 2}', "bad")
    write_files(first.unionByName(first.where("MessageId = 'm0'")), places["source"])  # twice in one batch
    drained = run()
    assert (drained.received, drained.rejected, ids(drained)) == (3, 1, ["m0", "m1"])
    write_files(messages(spark, '{"a": 2}', "bad", '{"a": 3}', first=1), places["source"])  # m1 and m2 again, in a later run
    # the file is as old as files can be: nothing is late
    for path in Path(places["source"]).glob("*.json"):
        os.utime(path, (1, 1))
    later = run()
    assert (later.received, ids(later)) == (1, ["m3"])
    assert run().paths == ()


def test_messages_without_id_are_no_copies(spark, places):
    plain = messages(spark, '{"a": 1}', '{"a": 1}', '{"a": 1}')
    for empty in (None, ""):
        write_files(plain.withColumn("MessageId", F.lit(empty).cast("string")), places["source"])
    Path(places["source"], "broken.json").write_text('no envelope\nno envelope\n')
    result = drain_messages(
        spark, places["source"], places["landing"], places["checkpoint"], MESSAGE_SCHEMA, once_by="MessageId"
    )
    assert (result.received, result.saved, result.rejected) == (8, 6, 2)
