from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import plan_text, scan_metric
from pyspark.sql import functions as F

from tidemark.operators import filters, joins, ledger, marks, rows, windows

AT = datetime(2024, 1, 31, 6, 15)


def stamps(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "ts timestamp_ntz")


# --- filters -------------------------------------------------------------------


def test_newer_than_is_strict_and_first_run_loads_all(spark):
    df = stamps(spark, datetime(2024, 1, 1), datetime(2024, 1, 2))
    assert filters.newer_than(df, "ts", datetime(2024, 1, 1)).count() == 1
    assert filters.newer_than(df, "ts", None).count() == 2


def test_mark_filter_reaches_the_scan(spark, tmp_path):
    spark.range(5).select((F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert "GreaterThan(ts," in plan_text(filters.newer_than(df, "ts", datetime(2023, 1, 1)))
    plan = plan_text(filters.on_days(df, "ts", date(2024, 1, 1), date(2024, 1, 2)))
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_matching(spark):
    df = spark.range(4)
    assert filters.matching(df, "id > 2").count() == 1
    assert filters.matching(df, None).count() == 4
    with pytest.raises(Exception, match="(?i)unresolved|cannot be resolved"):
        filters.matching(df, "nothing = 1").count()


def test_text_times_cross_a_month_end(spark):
    df = spark.createDataFrame([("31-01-2024 23:59:59",), ("01-02-2024 00:00:00",), ("02-01-2024 00:00:00",), ("?",)], "c string")
    got = filters.text_time_between(df, "c", datetime(2024, 1, 31), datetime(2024, 2, 1))
    assert sorted(r.c for r in got.collect()) == ["01-02-2024 00:00:00", "31-01-2024 23:59:59"]


def test_instants_with_other_offsets(spark):
    df = spark.createDataFrame([("2024-01-02T02:30:00+00:00",), ("2024-01-02T03:00:00Z",), ("bad",), (None,)], "c string")
    got = filters.instant_between(df, "c", "2024-01-01T00:00:00-03:00", "2024-01-01T23:59:59-03:00")
    assert [r.c for r in got.collect()] == ["2024-01-02T02:30:00+00:00"]


# --- marks -------------------------------------------------------------------


def test_mark_ignores_the_future_and_may_be_absent(spark):
    df = stamps(spark, datetime(2024, 1, 1), datetime(2024, 1, 5))
    assert marks.last_mark(df, "ts", datetime(2024, 1, 3)) == datetime(2024, 1, 1)
    assert marks.last_mark(df.where("false"), "ts", datetime(2024, 1, 3)) is None


def test_known_mark_only_saves_work(spark, tmp_path):
    days = [datetime(2024, 1, d) for d in (1, 5, 9)]
    stamps(spark, *days).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for known in (None, days[0], days[1], datetime(2024, 1, 6), datetime(2030, 1, 1)):
        assert marks.last_mark(df, "ts", datetime(2024, 1, 7), known=known) == days[1]
    plan = plan_text(marks.high_water_mark(df, "ts", datetime(2024, 1, 7), at_least=days[1]))
    assert "GreaterThanOrEqual(ts," in plan and "LessThanOrEqual(ts," in plan


def test_mark_over_day_first_text(spark):
    df = spark.createDataFrame([("31-01-2024 00:00:00",), ("01-02-2024 00:00:00",), ("none",)], "c string")
    assert marks.last_mark(df, "c", datetime(2024, 3, 1), "day_first") == datetime(2024, 2, 1)


# --- windows -------------------------------------------------------------------


def collected(df):
    return [(r.start, r.stop) for r in df.orderBy("start").collect()]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    start=st.datetimes(datetime(2024, 1, 1), datetime(2024, 3, 1)).map(lambda d: d.replace(hour=0, minute=0, second=0, microsecond=0)),
    length=st.integers(0, 5 * 24 * 3600),
    per_day=st.sampled_from(windows.SLICES_PER_DAY),
)
def test_slices_cover_without_overlap(spark, start, length, per_day):
    end = start + timedelta(seconds=length)
    got = collected(
        windows.subday_slices(windows.one_row(spark), windows.wall_time(start), windows.wall_time(end), per_day)
    )
    if start == end:
        assert got == []
        return
    assert got[0][0] == start and got[-1][1] == end
    assert all(a[1] == b[0] for a, b in zip(got, got[1:]))
    assert all(timedelta(0) < b - a <= timedelta(hours=24 // per_day) for a, b in got)


def test_other_slice_counts_raise(spark):
    with pytest.raises(ValueError, match="slices per day"):
        windows.subday_slices(windows.one_row(spark), F.current_date(), F.current_date(), 4)


def test_whole_days(spark):
    base = windows.one_row(spark)
    got = collected(windows.whole_days(base, windows.wall_time(datetime(2024, 1, 30, 22)), date(2024, 2, 2)))
    day = datetime(2024, 1, 31)
    assert got == [(day, day + timedelta(1)), (day + timedelta(1), day + timedelta(2))]
    for mark in (datetime(2024, 2, 1, 1), datetime(2024, 2, 2), datetime(2024, 2, 9)):
        assert collected(windows.whole_days(base, windows.wall_time(mark), date(2024, 2, 2))) == []


def test_days_since():
    # files dated after the mark's day: 13th..20th
    assert windows.days_since(datetime(2024, 1, 12, 23, 59), datetime(2024, 1, 20, 0, 1)) == 7
    assert windows.days_since(datetime(2024, 1, 20), datetime(2024, 1, 20, 5)) == -1


def test_window_rules(spark):
    mark, now = datetime(2024, 1, 10, 5), datetime(2024, 1, 11, 9)
    rule = windows.WindowRule
    assert collected(windows.window_for(spark, rule("hourly"), mark, now)) == [(mark, now)]
    manual = rule("manual", start=datetime(2024, 1, 1), stop=datetime(2024, 1, 2))
    assert collected(windows.window_for(spark, manual, None, now)) == [(datetime(2024, 1, 1), datetime(2024, 1, 2))]
    daily = collected(windows.window_for(spark, rule("daily", days=2, per_day=2), mark, now))
    assert daily[0][0] == datetime(2024, 1, 9) and daily[-1] == (datetime(2024, 1, 11), now) and len(daily) == 5
    for bad in (rule("weekly"), rule("manual")):
        with pytest.raises(ValueError):
            windows.window_for(spark, bad, mark, now)
    with pytest.raises(ValueError, match="needs a mark"):
        windows.window_for(spark, rule("hourly"), None, now)


# --- joins -------------------------------------------------------------------


def brute(events, spans):
    return sorted((t, a) for t in events for a, b in spans if a <= t < b)


def test_in_windows_against_brute_force(spark):
    day = datetime(2024, 1, 1)
    events = [day + timedelta(hours=h) for h in range(0, 120, 5)] + [day + timedelta(days=1)] * 3
    spans = [
        (day, day + timedelta(days=1)),  # ends at a midnight
        (day + timedelta(hours=20), day + timedelta(days=3, hours=1)),  # crosses days, overlaps
        (day + timedelta(days=1), day + timedelta(days=1, hours=8)),
        (day + timedelta(days=40), day + timedelta(days=41)),
    ]
    windows_df = spark.createDataFrame(spans, "start timestamp_ntz, stop timestamp_ntz")
    got = joins.in_windows(stamps(spark, *events), "ts", windows_df)
    assert sorted((r.ts, r.start) for r in got.collect()) == brute(events, spans)
    assert "NestedLoop" not in plan_text(got) and "Cartesian" not in plan_text(got)


def test_covering_filter_only_without_gaps(spark):
    day = datetime(2024, 1, 1)
    df = stamps(spark, day, day + timedelta(hours=30), day + timedelta(days=5))
    joined = spark.createDataFrame([(day, day + timedelta(1)), (day + timedelta(1), day + timedelta(2))], "start timestamp_ntz, stop timestamp_ntz")
    assert joins.in_windows_union(df, "ts", joined).count() == 2
    assert joins.in_windows_union(df, "ts", joined.where("false")).count() == 0
    gap = spark.createDataFrame([(day, day + timedelta(1)), (day + timedelta(2), day + timedelta(3))], "start timestamp_ntz, stop timestamp_ntz")
    with pytest.raises(ValueError, match="gaps"):
        joins.in_windows_union(df, "ts", gap)


def test_attach_metadata(spark):
    messages = spark.createDataFrame([(1, "a"), (2, "b")], "id int, receive string")
    one = spark.createDataFrame([("r", 0)], "RequestId string, RetryAttempts int")
    out = joins.attach_metadata(messages, one)
    assert out.columns == ["id", "receive", "RequestId", "RetryAttempts"]
    assert sorted(map(tuple, out.collect())) == [(1, "a", "r", 0), (2, "b", "r", 0)]
    with pytest.raises(Exception, match="(?i)more than one row|SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        joins.attach_metadata(messages, one.union(one)).collect()
    keyed = spark.createDataFrame([("a", "ra")], "receive string, RequestId string")
    assert sorted((r.id, r.RequestId) for r in joins.attach_metadata(messages, keyed, "receive").collect()) == [(1, "ra"), (2, None)]


# --- rows -------------------------------------------------------------------


def test_one_per_key_is_decided_by_all_columns(spark):
    data = [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "x"), (None, 1, "n")]
    df = spark.createDataFrame(data, "k int, t int, v string")
    want = {(1, 2, "c"), (2, None, "x"), (None, 1, "n")}
    for n in (1, 3):
        got = rows.one_per_key(df.repartition(n), ["k"], ["t"])
        assert got.columns == ["k", "t", "v"]
        assert {tuple(r) for r in got.collect()} == want


def test_distinct_and_unions(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert rows.distinct_rows(a).count() == 1
    assert {tuple(r) for r in rows.union_by_name([a, b]).collect()} == {(1, "x"), (2, "y")}
    lacking = rows.union_by_name([a, b.drop("s")], allow_missing=True)
    assert {tuple(r) for r in lacking.collect()} == {(1, "x"), (2, None)}
    with pytest.raises(Exception):
        rows.union_by_name([a, b.drop("s")]).collect()


def test_latest_file(spark, tmp_path):
    import os

    for n, name in enumerate(("c.csv", "a.csv", "b.csv")):
        path = tmp_path / "sub" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("x")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    got = rows.latest_file(spark, str(tmp_path)).first()
    assert got.path.endswith("/b.csv")


# --- ledger -------------------------------------------------------------------


def test_unread_paths(spark):
    entries = [
        ("q", "saved", False, "prd", "t"),
        ("q", "done", False, "prd", "t"),
        ("q", "done", True, "prd", "t"),
        ("q", "twice", False, "prd", "t"),
        ("q", "twice", False, "prd", "t"),
        ("q", None, False, "prd", "t"),
        ("q", "null", False, "prd", "t"),
        ("q", "elsewhere", False, "dev", "t"),
        ("other", "other", False, "prd", "t"),
    ]
    df = spark.createDataFrame(entries, ledger.LEDGER_SCHEMA)
    found = ledger.ledger_entries(df, "q", "prd")
    assert found.count() == 6
    assert sorted(r.path for r in ledger.unread_paths(found).collect()) == ["saved", "twice"]


def test_ledger_appends(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    ledger.append_paths(spark, folder, "q", "prd", [], False, AT)
    ledger.append_paths(spark, folder, "q", "prd", ["a", "b"], False, AT)
    ledger.append_paths(spark, folder, "q", "prd", ["a"], True, AT)
    book = ledger.read_ledger(spark, folder)
    assert book.count() == 3 and {r.at for r in ledger.entry_times(book).collect()} == {AT}
    assert [r.path for r in ledger.unread_paths(ledger.ledger_entries(book, "q", "prd")).collect()] == ["b"]


def test_ledger_opens_one_queue_only(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    for queue, env in (("q", "prd"), ("q", "dev"), ("007", "prd"), ("a b/%[1]", "prd")):
        ledger.append_paths(spark, folder, queue, env, [f"{queue}-{env}"], False, AT)
    for queue in ("q", "007", "a b/%[1]"):
        mine = ledger.ledger_entries(ledger.read_ledger(spark, folder), queue, "prd")
        assert [r.path for r in mine.collect()] == [f"{queue}-prd"]
        assert scan_metric(mine, "numFiles") == 1


@pytest.mark.parametrize("queue", ["q", "a b/%[1]"])
def test_ledger_stays_small_over_runs(spark, tmp_path, queue):
    folder = str(tmp_path / "ledger")
    ledger.append_paths(spark, folder, "other", "prd", ["kept"], False, AT)
    for run in range(12):
        ledger.append_paths(spark, folder, queue, "prd", [f"p{run}", f"r{run}"], False, AT)
        ledger.append_paths(spark, folder, queue, "prd", [f"r{run}"], True, AT)
        ledger.fold_ledger(spark, folder, queue, "prd", files=6)
        assert len(ledger._data_files(spark, folder)) <= 1 + 6
    entries = ledger.ledger_entries(ledger.read_ledger(spark, folder), queue, "prd")
    assert entries.count() == 36  # 24 saved, 12 read: the facts themselves are unchanged
    assert {r.path for r in ledger.unread_paths(entries).collect()} == {f"p{run}" for run in range(12)}
    other = ledger.ledger_entries(ledger.read_ledger(spark, folder), "other", "prd")
    assert [r.path for r in ledger.unread_paths(other).collect()] == ["kept"]
    assert not list((tmp_path / "ledger" / "_writing").iterdir())


def test_broken_fold_changes_no_answer(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "ledger")
    for run in range(4):
        ledger.append_paths(spark, folder, "q", "prd", [f"p{run}"], run == 3, AT)
    real = ledger.filesystem

    class NoDelete:
        def delete(self, *_):
            raise OSError("crash before the first delete")

    # the snapshot is in place, its sources could not go: facts stand twice
    monkeypatch.setattr(ledger, "filesystem", lambda s, p: (NoDelete(), real(s, p)[1]) if p == folder else real(s, p))
    with pytest.raises(OSError, match="crash"):
        ledger.fold_ledger(spark, folder, "q", "prd", files=2)
    monkeypatch.undo()
    unread = lambda: {r.path for r in ledger.unread_paths(ledger.ledger_entries(ledger.read_ledger(spark, folder), "q", "prd")).collect()}
    assert len(ledger._data_files(spark, folder)) == 5 and unread() == {"p0", "p1", "p2"}
    assert ledger.fold_ledger(spark, folder, "q", "prd", files=2) == 5
    assert len(ledger._data_files(spark, folder)) == 1 and unread() == {"p0", "p1", "p2"}
    assert ledger.fold_ledger(spark, folder, "q", "prd", files=2) == 0
