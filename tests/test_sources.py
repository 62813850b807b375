from __future__ import annotations

import csv
import io
import os
import random
import zipfile
from datetime import date, datetime

import pytest
from plans import scan_metric
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.sources import archives, databases, documents, envelopes, files


def put(folder, name, content, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(content if isinstance(content, bytes) else content.encode(encoding))
    return str(folder)


def test_suffix_selection(spark, tmp_path):
    put(tmp_path / "r", "a_overview.csv", "x\n1\n")
    folder = put(tmp_path / "r", "a_other.csv", "x\n2\n")
    assert [r.x for r in files.scan_by_suffix(spark, folder, "_overview.csv").collect()] == ["1"]


def test_leading_dates_cross_a_month_end(spark, tmp_path):
    for day in ("28-01-2024", "31-01-2024", "01-02-2024", "02-02-2024", "05-02-2024", "no-date"):
        folder = put(tmp_path / "f", f"{day}_x.csv", f"d\n{day}\n")
    got = files.select_dated_files(files.naive_csv(spark, folder), files.leading_date(), date(2024, 2, 2), 2)
    assert sorted(r.d for r in got.collect()) == ["01-02-2024", "02-02-2024", "31-01-2024"]
    assert {r[files.FILE_DATE] for r in got.collect()} == {date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 2)}
    # the files outside the window are not opened
    assert scan_metric(got, "numFiles") == 3


def test_trailing_dates_and_full_selection(spark, tmp_path):
    for day in ("20240130", "20240201"):
        folder = put(tmp_path / "f", f"x_visits_{day}.csv", f"d\n{day}\n")
    rows = files.naive_csv(spark, folder)
    one = files.select_dated_files(rows, files.trailing_date("visits_"), date(2024, 2, 2), 1)
    assert [r.d for r in one.collect()] == ["20240201"]
    every = files.select_dated_files(rows, files.trailing_date("visits_"), date(2024, 2, 2), None)
    assert every.count() == 2


REPORT = 'a b,c,d\n1,"x, ""y""\nz",3\n1,2\n1,2,3,4\n\n5,,6\n'


def test_quoted_csv(spark, tmp_path):
    folder = put(tmp_path / "q", "r.csv", REPORT)
    out = files.report_rows(spark, folder)
    assert out.columns == ["a_b", "c", "d"]
    assert sorted(map(tuple, out.collect())) == [("1", 'x, "y"\nz', "3"), ("5", "", "6")]
    assert out.count() == 2 and out.select("d").count() == 2


def test_files_of_two_widths_in_one_scan_raise(spark, tmp_path):
    put(tmp_path / "w", "1.csv", "a,b\n1,2\n")
    folder = put(tmp_path / "w", "2.csv", "a,b,c\n3,4,5\n")
    for reader in (files.naive_csv, files.quoted_csv):
        with pytest.raises(Exception, match="(?i)header"):
            reader(spark, folder).collect()
    assert sorted(map(tuple, files.report_rows(spark, folder).collect())) == [("1", "2", ""), ("3", "4", "5")]


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_reports_with_line_breaks_over_many_splits(spark, tmp_path, split):
    rng = random.Random(split)
    wanted = []
    for k in range(3):
        rows = [[str(i), "".join(rng.choices(["a", "é", "\n", '"', ",", "\n\n", "x" * 30], k=rng.randint(0, 8))), "end"] for i in range(k * 100, k * 100 + 100)]
        rows[7][1] = "long \n" * 200  # one field over many splits
        header = ["a b", "text", "c"] if k < 2 else ["text", "a b", "c"]
        out = io.StringIO()
        writer = csv.writer(out, quoting=csv.QUOTE_ALL if k else csv.QUOTE_MINIMAL, lineterminator="\n")
        writer.writerow(header)
        writer.writerows(rows if k < 2 else [[r[1], r[0], r[2]] for r in rows])
        folder = put(tmp_path / "big", f"{k}.csv", out.getvalue() + "ragged,row\n")
        wanted += [tuple(r) for r in rows]
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = files.report_rows(spark, folder)
        spark.conf.set("spark.sql.files.maxPartitionBytes", 333)  # other splits from now on
        assert sorted(map(tuple, got.select("a_b", "text", "c").collect())) == sorted(wanted)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_reports_with_odd_ends(spark, tmp_path):
    put(tmp_path / "o", "1.csv", '\ufeffa,b\r\n1,"x\r\ny"\r\n\r\n2,\r\n')
    folder = put(tmp_path / "o", "2.csv", 'a,b\n3,"never closed\nat all')
    put(tmp_path / "o", "3.csv", "")
    got = sorted(map(tuple, files.report_rows(spark, folder).collect()))
    assert got[:2] == [("1", "x\ny"), ("2", "")] and got[2][0] == "3" and "at all" in got[2][1]
    with pytest.raises(files.NoFiles):
        files.report_rows(spark, put(tmp_path / "none", "x.csv", ""))


def test_naive_csv_keeps_quotes_and_drops_ragged(spark, tmp_path):
    folder = put(tmp_path / "n", "r.csv", 'a,b\n"x",1\n"p,q",2\n3\n,\n')
    out = files.naive_csv(spark, folder)
    assert sorted(map(tuple, out.collect())) == [("", ""), ('"x"', "1")]
    assert out.select("a").count() == 2


def test_split_fields(spark):
    lines = spark.createDataFrame([("1,2,",), ("1,2",), ("a,b,c,d",)], "line string")
    out = files.split_fields(lines, "x y,z,w")
    assert out.columns == ["x_y", "z", "w"]
    assert [tuple(r) for r in out.collect()] == [("1", "2", "")]


def test_charsets(spark, tmp_path):
    cases = {
        "utf8.csv": ("a,b\né,1\n".encode(), "UTF-8"),
        "bom.csv": ("﻿a,b\né,1\n".encode(), "UTF-8"),
        "ascii.csv": (b"a,b\nx,1\n", "UTF-8"),
        "latin.csv": ("a,b\nxyz,0\né,1\n".encode("latin-1"), "ISO-8859-1"),
        "le.csv": (b"\xff\xfe" + "a,b\né,1\n".encode("utf-16-le"), "UTF-16LE"),
        "be.csv": (b"\xfe\xff" + "a,b\né,1\n".encode("utf-16-be"), "UTF-16BE"),
    }
    for name, (content, _) in cases.items():
        folder = put(tmp_path / "c", name, content)
    got = {os.path.basename(r.path): r.charset for r in files.detect_charsets(spark, folder).collect()}
    assert got == {name: charset for name, (_, charset) in cases.items()}
    rows = files.detected_csv(spark, folder)
    assert rows.columns == ["a", "b"]
    assert sorted(map(tuple, rows.collect())) == [("x", "1"), ("xyz", "0")] + [("é", "1")] * 5


def test_large_latin_file_in_many_splits(spark, tmp_path):
    # the only byte that tells the charset stands at the very end
    folder = put(tmp_path / "c", "big.csv", b"a,b\n" + b"xxxxxxxxxx,1\n" * 50_000 + "é,2\n".encode("latin-1"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        assert files.detect_charsets(spark, folder).first().charset == "ISO-8859-1"
        assert files.detected_csv(spark, folder).where("b = 2").first().a == "é"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_utf16_with_mark_and_variant_headers(spark, tmp_path):
    mark = b"\xff\xfe"
    put(tmp_path / "u", "a_overview.csv", mark + 'Package Name,Date\n"p, 1",d1\n'.encode("utf-16-le"))
    folder = put(tmp_path / "u", "b_overview.csv", mark + "Date,Package name,New\nd2,p2,n\n".encode("utf-16-le"))
    rows = files.csv_by_header(
        spark, folder, {"Package Name": "Package name"}, encoding="UTF-16LE", multi_line=True
    )
    got = {tuple(r) for r in rows.select("Package name", "Date", "New").collect()}
    assert got == {("p, 1", "d1", None), ("p2", "d2", "n")}
    assert files.utf16_csv(spark, folder, pathGlobFilter="b_*").columns == ["Date", "Package name", "New"]


def test_no_files_raise(spark, tmp_path):
    folder = put(tmp_path / "e", "x.txt", "")
    with pytest.raises(files.NoFiles):
        files.detected_csv(spark, folder)


def test_parquet_merge_schema(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "p/r=1"))
    spark.range(1).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "p/r=2"))
    assert "x" in files.scan_parquet(spark, str(tmp_path / "p"), merge_schema=True).columns


# --- archives ---------------------------------------------------------------


def archive(folder, name, members):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / name, "w") as packed:
        for member, content in members.items():
            packed.writestr(member, content)
    return str(folder)


def test_zip_members(spark, tmp_path):
    archive(
        tmp_path / "z", "01-02-2024_a.zip",
        {
            "msg_1.csv": "a b,c\n1,é\n2\n\n3,\"x\"\n",
            "msg_Reward.csv": "a b,c\n9,9\n",
            "other.csv": "a,b\n8,8\n",
            "msg_2.txt": "a,b\n7,7\n",
        },
    )
    folder = archive(tmp_path / "z", "02-02-2024_b.zip", {"msg_1.csv": "k,l\r\n4,5\r\n"})
    rows = archives.zipped_csv(spark, folder, "msg", "reward")
    assert rows.columns == ["a_b", "c", "path", "member"]
    assert sorted((r.a_b, r.c) for r in rows.collect()) == [("1", "é"), ("3", '"x"'), ("4", "5")]
    late = archives.zipped_csv(spark, folder, "msg", "reward", header="p,q", name_filter=F.col("path").contains("02-02"))
    assert [(r.p, r.q) for r in late.collect()] == [("4", "5")]
    # the keyword is in the member only, not in the prefix as written
    with pytest.raises(ValueError, match="no member"):
        archives.zipped_csv(spark, folder, "msg_Re", "reward")


def test_zip_members_of_other_widths_and_orders(spark, tmp_path):
    folder = archive(
        tmp_path / "z", "a.zip",
        {"m1.csv": "a b,c\n1,2\nragged\n", "m2.csv": "a b,c,d\n3,4,5\n6,7\n", "m3.csv": "c,a b\n9,8\n", "m4.csv": "c\n10\n", "m5.csv": "k,l\n11,12\n"},
    )
    for spread in (None, 3):
        rows = archives.zipped_csv(spark, folder, "m", "-", spread=spread)
        assert rows.columns == ["a_b", "c", "d", "path", "member"]
        got = sorted((r.member, r.a_b, r.c, r.d) for r in rows.collect())
        assert got == [("m1.csv", "1", "2", ""), ("m2.csv", "3", "4", "5"), ("m3.csv", "8", "9", ""), ("m4.csv", "", "10", ""), ("m5.csv", "11", "12", "")]
    with pytest.raises(ValueError, match="another number"):
        archives.zipped_csv(spark, folder, "m", "-", header="p,q")


def test_detected_files_of_other_widths_and_orders(spark, tmp_path):
    put(tmp_path / "d", "1.csv", "a,b\n1,2\nragged\n")
    put(tmp_path / "d", "2.csv", "a,b,c\né,4,5\n6,7\n".encode("latin-1"))
    put(tmp_path / "d", "3.csv", "b,a\r\n9,8\r\n")
    put(tmp_path / "d", "4.csv", b"\xff\xfe" + "a,b,c\n10,11,12\n".encode("utf-16-le"))
    folder = put(tmp_path / "d", "5.csv", "k,l\n13,14\n")
    rows = files.detected_csv(spark, folder)
    assert rows.columns == ["a", "b", "c"]
    assert sorted(map(tuple, rows.collect())) == sorted([("1", "2", ""), ("é", "4", "5"), ("8", "9", ""), ("10", "11", "12"), ("13", "14", "")])


def test_zip_keyword_in_prefix(spark, tmp_path):
    folder = archive(tmp_path / "z", "a.zip", {"reward_1.csv": "a\n1\n", "reward.csv": "a\n2\n", "x_reward.csv": "a\n3\n"})
    assert sorted(r.a for r in archives.zipped_csv(spark, folder, "reward", "reward").collect()) == ["1", "2"]
    with pytest.raises(ValueError, match="no member"):
        archives.zipped_csv(spark, folder, "nothing", "reward")


def test_zip_long_member_in_batches(spark, tmp_path):
    n = 45_001
    folder = archive(tmp_path / "z", "a.zip", {"m.csv": "a,b\n" + "".join(f"{i},x\n" for i in range(n))})
    lines = archives.zip_lines(spark, archives.zip_members(spark, folder, "m", "-"))
    assert lines.agg(F.count("*"), F.max("line_no"), F.countDistinct("line_no")).first() == (n + 1, n + 1, n + 1)
    rows = archives.zipped_csv(spark, folder, "m", "-", spread=4)
    assert rows.agg(F.sum(F.col("a").cast("long"))).first()[0] == n * (n - 1) // 2


def test_members_of_one_archive_go_to_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "TASK_BYTES", 100)
    body = {f"m{k}.csv": "a,b\n" + "".join(f"{k},{random.Random(i).random()}\n" for i in range(50)) for k in range(6)}
    folder = archive(tmp_path / "z", "a.zip", {**body, "empty.csv": "", "mempty.csv": ""})
    members = archives.zip_members(spark, folder, "m", "-")
    assert sorted(r.member for r in members.collect()) == sorted([*body, "mempty.csv"])
    lines = archives.zip_lines(spark, members)
    tasks = lines.select(F.spark_partition_id().alias("task"), "member").distinct().collect()
    assert len({r.task for r in tasks}) > 2 and len(tasks) == 6  # each member in one task, once
    assert archives.zipped_csv(spark, folder, "m", "-").count() == 300


def test_member_rule_matches_reader(spark):
    cases = [("m_x.csv", "m", "x", False), ("m_y.csv", "m", "x", True), ("mX.csv", "mX", "x", False), ("ax.csv", "ax", "x", True)]
    df = spark.createDataFrame(cases, "m string, p string, k string, wanted boolean")
    for r in df.select("*", archives.member_selected("m", F.col("p"), F.col("k")).alias("got")).collect():
        assert r.got is r.wanted, r.m


# --- documents and envelopes ---------------------------------------------------


def test_plain_documents(spark, tmp_path):
    folder = put(tmp_path / "d", "a.json", '{"id": 1, "n": {"x": 2}}\n{"id": "b", "extra": true}\n')
    rows = documents.plain_documents(spark, folder)
    assert rows.columns == ["extra", "id", "n"]
    assert {tuple(r) for r in rows.collect()} == {(None, "1", '{"x": 2}'), ("true", "b", None)}
    assert documents.plain_documents(spark, folder, ["id"]).columns == ["id"]
    with pytest.raises(documents.NoDocuments):
        documents.require_documents(rows.where("id = 'none'"))
    with pytest.raises(documents.NoDocuments):
        documents.plain_documents(spark, put(tmp_path / "e", "a.json", ""))


def test_typed_documents(spark):
    fields = (
        '{"s": {"stringValue": "x"}, "i": {"integerValue": "0"}, "d": {"doubleValue": 0.0}, "b": {"booleanValue": true},'
        ' "e": {"stringValue": ""}}'
    )
    rows = [
        (f'{{"document": {{"name": "a/b/k1", "fields": {fields}}}}}', 1),
        ('{"readTime": "t"}', 2),
        ('{"document": {"name": "a/b/k2"}}', 3),
    ]
    df = spark.createDataFrame(rows, "value string, n int")
    out = documents.typed_documents(df, ["s", "i", "d", "b", "e", "absent"], id_column="doc_id")
    assert [tuple(r) for r in out.orderBy("n").collect()] == [
        (1, "x", "0", "0.0", None, None, None, "k1"),
        (3, None, None, None, None, None, None, "k2"),
    ]
    assert documents.field_names(df) == ["b", "d", "e", "i", "s"]


def envelope(kind, value):
    return f'<env:Envelope xmlns:env="e"><env:Body><n:{kind} xmlns:n="x">{value}</n:{kind}></env:Body></env:Envelope>'


def test_xml_values(spark):
    def one(xml, kind, **options):
        return spark.createDataFrame([(xml,)], "x string").select(envelopes.xml_value("x", kind, **options)).first()[0]

    assert one(envelope("runReportResponse", "<return>r1</return>"), "report_id") == "r1"
    assert one(envelope("isReportRunningResponse", "<return>true</return>"), "is_running") == "true"
    assert one(envelope("getReportResultCsvResponse", "<return>a,b\n1,2</return>"), "result_csv") == "a,b\n1,2"
    assert one(envelope("runReportResponse", "<return></return>"), "report_id") == ""
    assert one(envelope("getReportResultCsvResponse", "<return> a,&quot;&amp;&quot; \n</return>"), "result_csv") == ' a,"&" \n'
    assert one(envelope("runReportResponse", ""), "report_id", required=False) is None
    for broken in ("broken <", None, "<Other><Body><runReportResponse><return>1</return></runReportResponse></Body></Other>"):
        assert one(broken, "report_id", required=False) is None
    with pytest.raises(Exception, match="response holds no"):
        one(envelope("other", ""), "report_id")
    with pytest.raises(ValueError, match="unknown response kind"):
        envelopes.response_schema("nope")


# --- databases (options only: no database is started) ---------------------------


def test_urls_and_engines():
    assert databases.jdbc_url("mysql", "h", 1, "d") == "jdbc:mysql://h:1/d"
    assert databases.jdbc_url("postgresql", "h", 1, "d") == "jdbc:postgresql://h:1/d"
    assert databases.jdbc_url("sqlserver", "h", 1, "d") == "jdbc:sqlserver://h:1;encrypt=false;"
    with pytest.raises(ValueError, match="unknown database engine"):
        databases.jdbc_url("other", "h", 1, "d")
    assert databases.resolve_engine("x") == "mysql"
    assert databases.resolve_engine("My_Finance_DB", sqlserver_names=["finance_db"]) == "sqlserver"
    assert databases.resolve_engine("finance_db", "postgresql", ["finance_db"]) == "postgresql"


def test_jdbc_options():
    connection = databases.Connection("jdbc:x", "u", "p", driver="drv")
    assert "p" not in repr(connection).replace("'jdbc:x'", "").split("password")[-1]
    slices = databases.Slices("id", 1, 100, 8)
    table = databases.table_options(connection, "s.t", slices)
    assert table["dbtable"] == "s.t" and table["numPartitions"] == "8" and table["driver"] == "drv"
    plain = databases.query_options(connection, "SELECT 1")
    assert plain["query"] == "SELECT 1" and "dbtable" not in plain
    sliced = databases.query_options(connection, "SELECT 1", slices)
    assert sliced["dbtable"] == "(SELECT 1) AS extract_rows" and "query" not in sliced


def test_incremental_condition():
    assert databases.incremental_condition("c >", None) is None
    assert databases.incremental_condition("c >", datetime(2024, 1, 2, 3)) == "c > '2024-01-02 03:00:00'"
    assert databases.incremental_condition("c >", "o'x") == "c > 'o''x'"


def test_a_marked_line_that_is_not_first_is_no_mark(spark, tmp_path):
    put(tmp_path / "c", "a.csv", b"a,b\n" + b"\xff\xfeq,1\n")
    folder = put(tmp_path / "c", "b.csv", b"\xff\xfeq,1\n" + b"")
    got = {os.path.basename(r.path): r.charset for r in files.detect_charsets(spark, folder).collect()}
    assert got == {"a.csv": "ISO-8859-1", "b.csv": "UTF-16LE"}


def test_detection_opens_only_selected_files_and_hashes(spark, tmp_path):
    from plans import plan_text

    for day in ("20240130", "20240201", "20240202"):
        folder = put(tmp_path / "f", f"x_visits_{day}.csv", f"d\n{day}\n")
    wanted = files.within_days(files.trailing_date("visits_"), date(2024, 2, 2), 1)
    listing = files.detect_charsets(spark, folder, wanted)
    assert scan_metric(listing, "numFiles") == 2
    assert "SortAggregate" not in plan_text(listing)
    assert files.detected_csv(spark, folder, selected=wanted).count() == 2


# --- replies -----------------------------------------------------------------


def reply(csv_text, element="getReportResultCsvResponse"):
    inner = csv_text.replace("&", "&amp;").replace("<", "&lt;")
    return f'<?xml version="1.0"?>\n<e:Envelope xmlns:e="urn:e"><e:Body><r:{element} xmlns:r="urn:r"><return>{inner}</return></r:{element}></e:Body></e:Envelope>\n'


def test_replies_are_read_like_reports(spark, tmp_path):
    texts = {
        "a": 'Agent Name,Note\n1,"x\n""y"", & <z>"\n\n2,plain\n3,too,many\n4,"open\n',
        "b": "Note,Agent Name,More\r\nn,5,m\r\n",  # other order and width
        "c": "",  # an empty value
        "d": "Agent Name,Note",  # a header only
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.xml").write_text(reply(text), newline="")
    got = files.reply_rows(spark, str(tmp_path))
    assert got.columns == ["Agent_Name", "Note", "More"]
    rows = sorted(tuple(r) for r in got.collect() if r.Agent_Name != "4")
    assert rows == [("1", 'x\n"y", & <z>', ""), ("2", "plain", ""), ("5", "n", "m")]


def test_a_reply_without_the_value_raises(spark, tmp_path):
    (tmp_path / "a.xml").write_text(reply("a,b\n1,2", "runReportResponse"))
    with pytest.raises(Exception, match="response holds no result_csv"):
        files.reply_rows(spark, str(tmp_path)).collect()


def test_empty_replies_hold_no_lines(spark, tmp_path):
    (tmp_path / "a.xml").write_text(reply(""))
    with pytest.raises(files.NoFiles):
        files.reply_rows(spark, str(tmp_path))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='a",\n é', max_size=6), min_size=2, max_size=2), min_size=1, max_size=6))
def test_records_of_a_payload_match_a_csv_reader(table):
    from tidemark.sources.records import _records_of

    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(table)
    got = [next(csv.reader(io.StringIO(text, newline=""))) for text in _records_of(out.getvalue())]
    assert got == table


def test_long_payloads_leave_in_batches():
    import pyarrow as pa

    from tidemark.sources.records import _RECORDS_AT_ONCE, _payload_records

    lines = "\n".join(f"{n},x" for n in range(_RECORDS_AT_ONCE + 5))
    batch = pa.RecordBatch.from_pydict({"path": ["p", "q", "r"], "payload": [lines, None, "h\n1"]})
    out = list(_payload_records(iter([batch])))
    assert [b.num_rows for b in out] == [_RECORDS_AT_ONCE, 5, 2]
    assert [sum(b.column("first").to_pylist()) for b in out] == [1, 0, 1]
