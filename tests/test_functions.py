from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions import audit, names, payload, text, times


def test_clean_name_rules():
    assert names.clean_name(" a,b;{c}(d)\n\t= ") == "a_b_c_d"
    assert names.clean_name("__x__y_") == "x_y"
    assert names.clean_name("plain") == "plain"


def test_clean_column_names_keeps_and_collides(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "_audit"])
    assert names.clean_column_names(df).columns == ["a_b", "audit"]
    assert names.clean_column_names(df, keep=["_audit"]).columns == ["a_b", "_audit"]
    with pytest.raises(names.ColumnNameCollision):
        names.clean_column_names(spark.createDataFrame([(1, 2)], ["a b", "A;b"]))


def test_assert_legal_names(spark):
    names.assert_legal_names(spark.createDataFrame([(1,)], ["ok"]))
    for bad in names.ILLEGAL_CHARACTERS:
        with pytest.raises(names.IllegalColumnName):
            names.assert_legal_names(spark.createDataFrame([(1,)], [f"a{bad}b"]))


def test_harmonize_ignores_absent(spark):
    df = spark.createDataFrame([(1,)], ["Package Name"])
    assert names.harmonize_columns(df, {"Package Name": "Package name", "x": "y"}).columns == ["Package name"]


def test_audit_columns_in_order_with_count(spark):
    df = spark.range(7)
    out = audit.with_fixed_audit(df, "s", "t", "c", "o")
    assert out.columns == ["id", "_data_source", "_source_type", "_cost_center", "_system_owner", "_qt_rows"]
    assert {r._qt_rows for r in out.collect()} == {7}
    out = audit.with_audit(df, {"_a": 1, "_b": None})
    assert out.columns == ["id", "_a", "_b", "_qtd_rows"]
    assert audit.with_audit(df.where("id < 0"), {"_a": 1}).count() == 0


@pytest.mark.parametrize(("month", "hours"), [(1, 5), (7, 4)])
def test_zone_offset(spark, month, hours):
    at = datetime(2024, month, 10, 12, tzinfo=timezone.utc)
    assert audit.zone_offset_hours(at, "US/Pacific", "America/Sao_Paulo") == hours
    stamp = spark.createDataFrame([(at.replace(tzinfo=None),)], "t timestamp_ntz")
    assert stamp.select(times.zone_offset_hours("t", "US/Pacific", "America/Sao_Paulo")).first()[0] == hours


BODIES = [
    ('{"a": 1}', True),
    ('{"a": {"b": [1, 2]}}', True),
    ("[1, 2]", True),
    ("null", True),
    ("3", True),
    ('"x"', True),
    ('{"a": 1, "a": 2}', True),
    ("", False),
    (None, False),
    ("bare text", False),
    ('{"a": 1', False),
    ('{"a": 1} x', False),
    ("1, 2", False),
    ("1], [2", False),
    ('1}, {"v": 2', False),
    ("{a: 1}", False),
]


def test_valid_json(spark):
    df = spark.createDataFrame(BODIES, "Body string, wanted boolean")
    for row in df.select("*", payload.is_valid_json("Body").alias("got")).collect():
        assert row.got is row.wanted, row.Body
    good, bad = payload.split_valid(df)
    assert good.count() == 7 and bad.count() == 9


def test_normalize_json(spark):
    df = spark.createDataFrame([('{ "b": 1.50, "a": [1,  2] }',), ("null",), ('{"a":1,"a":2}',)], "b string")
    got = [r[0] for r in df.select(payload.normalize_json("b")).collect()]
    assert got == ['{"a":[1,2],"b":1.5}', "null", '{"a":1,"a":2}']


def test_flatten_body(spark):
    schema = payload.all_string_schema(["nome", "tags", "valor"])
    rows = [
        ('{"valor": 1.5, "tags": [{"k": 1}], "nome": "x", "other": 1}', "h", 0, "m1", "r"),
        ('{"nome": true}', "h", 0, "m2", "r"),
        ("broken", "h", 0, "m3", "r"),
    ]
    df = spark.createDataFrame(rows, "Body string, HTTPHeaders string, RetryAttempts long, MessageId string, RequestId string")
    out = payload.flatten_body(df, schema)
    assert out.columns == ["nome", "tags", "valor", *payload.ENVELOPE_COLUMNS]
    got = {r.MessageId: (r.nome, r.tags, r.valor) for r in out.collect()}
    assert got == {"m1": ("x", '[{"k":1}]', "1.5"), "m2": ("true", None, None), "m3": (None, None, None)}


def test_stringify_keeps_null(spark):
    df = spark.createDataFrame([(1, None, True)], "a int, b double, `c.d` boolean")
    assert payload.stringify_all(df).first() == ("1", None, "true")


def test_text_helpers(spark):
    df = spark.createDataFrame([("a/b/c", "hELLO wORLD", "")], "p string, n string, e string")
    row = df.select(
        text.last_part("p"), text.part_before("p", "/"), text.part_after("p", "/"), text.capitalize("n"),
        text.capitalize("e"), text.first_filled("e", "p"), text.replace_text("p", "/", "-"),
    ).first()
    assert tuple(row) == ("c", "a", "b", "Hello world", "", "a/b/c", "a-b-c")


def test_times(spark):
    df = spark.createDataFrame([("31-01-2024 10:00:01", "2024-01-31 10:00:01.987", "99-99-2024")], "a string, b string, c string")
    row = df.select(times.parse_time("a", "day_first"), times.parse_seconds("b"), times.parse_date("c", "date_day_first")).first()
    assert tuple(row) == (datetime(2024, 1, 31, 10, 0, 1), datetime(2024, 1, 31, 10, 0, 1), None)


def test_row_count_needs_no_cross_join_or_window(spark, tmp_path):
    from plans import plan_text

    spark.range(10).write.parquet(str(tmp_path / "x"))
    plan = plan_text(audit.with_row_count(spark.read.parquet(str(tmp_path / "x"))))
    assert "Subquery" in plan and "NestedLoop" not in plan and "Window" not in plan


def test_struct_to_json_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(payload.struct_to_json("a", "b")).first()[0] == '{"a":1,"b":null}'
    assert df.select(payload.struct_to_json("a", "b", keep_nulls=False)).first()[0] == '{"a":1}'
    assert df.select(F.lit(1)).count() == 1
