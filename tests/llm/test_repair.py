"""Conversation repair against all possible edits, block by block against whole, and its rows against its digest."""

from __future__ import annotations

import hashlib
import re
from functools import cache

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import queries, repair

PATTERN = re.compile(r"(s?(ua)+)?")
ROWS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["a.", "b", " \n", "a.", "c!"])), max_size=6)


def all_repairs(rows):
    """Every sequence of edits with as many insertions as could pay, and what each costs."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip()
        faults.append(2 if not body or (role, text) in seen else 1 if body[-1] not in ".!?" else 0)
        seen.add((role, text))

    @cache
    def of(i, inserts):
        out = [(0, "", ())] if i == len(rows) else []
        if inserts:
            out += [(c + 2, "I" + a, ((r, ""),) + t) for r in ("user", "assistant") for c, a, t in of(i, inserts - 1)]
        if i < len(rows):
            role, text = rows[i]
            rest = of(i + 1, inserts)
            out += [(c + 3, "D" + a, t) for c, a, t in rest]
            if faults[i] < 2:
                out += [(c + faults[i], "K" + a, ((role, text),) + t) for c, a, t in rest]
                out += [(c + 2 + faults[i], "R" + a, ((r, text),) + t) for r in ("user", "assistant") for c, a, t in rest]
        return out

    fit = [(c, a, t) for c, a, t in of(0, 3) if PATTERN.fullmatch("".join(r[:1] or " " for r, _ in t))]
    return min(fit)


def found(rows):
    c, seen = repair.Conversation(1), set()
    for turn, (role, text) in enumerate(rows):
        c.take(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    return c.report()


@settings(max_examples=120, deadline=None)
@given(ROWS.filter(lambda rows: len(rows) < 5))
def test_cheapest_of_all_repairs(rows):
    report = found(rows)
    cost, audit, turns = all_repairs(tuple(rows))
    assert (report[6], report[7]) == (cost, audit)
    assert report[9] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(ROWS, max_size=6).map(lambda parts: [r for p in parts for r in p]), st.integers(1, 4))
def test_blocks_change_nothing(rows, size):
    whole = found(rows)
    before = repair.BLOCK_ROWS
    repair.BLOCK_ROWS = size
    try:
        assert found(rows) == whole
    finally:
        repair.BLOCK_ROWS = before


COLUMNS = "conv_id long, turn long, role string, text string, gone boolean, cost int, audit string"


@pytest.fixture
def talks(spark):
    long = [(9, k, ("user", "assistant")[k % 2], f"line {k}." + " x" * 50 + ".", False, 0, "") for k in range(3000) if k % 7]
    rows = [
        (1, None, None, None, False, 0, ""), (1, 0, "user", "Hi.", False, 0, ""), (1, 0, "user", "Hi.", False, 0, ""), (1, 3, "assistant", "Yes", False, 0, ""),
        (2, 0, "user", "Gone.", True, 0, ""), (None, 1, "user", "No id.", False, 0, ""), (None, 2, "assistant", "Yes.", False, 0, ""),
        (3, None, "system", "Be brief.", False, 0, ""), (3, 1, "assistant", "Ok.", False, 0, ""), (4, 5, "user", "x" * 1_000_000 + ".", False, 0, ""),
    ]
    return spark.createDataFrame(rows + long, COLUMNS).repartition(3)


def test_reports_of_odd_rows(spark, talks):
    reports = {r["conv_id"]: r for r in repair.repair(talks, F.col("gone")).collect()}
    assert set(reports) == {None, 1, 2, 3, 4, 9}
    nothing = hashlib.sha256(b"").hexdigest()
    two = reports[2]
    assert (two["gaps"], two["blank"], two["cost"], two["audit"], two["repaired_sha256"]) == (0, 0, 0, "", nothing)
    one = reports[1]
    assert (one["gaps"], one["blank"], one["duplicate"], one["truncated"], one["illegal"]) == (2, 1, 1, 1, 2)
    assert (one["cost"], one["audit"]) == (7, "DKDK")
    assert (reports[None]["cost"], reports[None]["audit"], reports[3]["audit"], reports[4]["audit"]) == (0, "KK", "KIK", "KI")
    assert reports[9]["cost"] > 0 and len(reports[9]["audit"]) > repair.BLOCK_ROWS
    assert repair.repair(talks.limit(0)).count() == 0


def test_turns_are_what_the_digest_says(spark, talks):
    reports = repair.repair(talks, F.col("gone"))
    turns = repair.repaired_turns(talks, reports, F.col("gone")).collect()
    by = {}
    for r in sorted(turns, key=lambda r: r["place"]):
        by.setdefault(r["conv_id"], []).append(r)
    for report in reports.collect():
        lines = [f"{r['role']}:{r['text']}" for r in by.get(report["conv_id"], [])]
        assert report["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert PATTERN.fullmatch("".join(r["role"][0] for r in by.get(report["conv_id"], [])))


def test_query_is_its_sql_on_hostile_rows(spark, tmp_path):
    from random import Random

    rng = Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "No", "", None, " \t", "Why?", "ünd", "a\nb!", "Yes."]
    rows = [(rng.choice([1, 2, 3, 4, None]) if k % 50 == 0 else 5 + k // 6, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for k in range(1500)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    mine = queries.QUERIES["op13_repair"](spark, str(tmp_path))
    twin = con.execute(queries.ORACLES["op13_repair"]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(str, twin)) == sorted(str(tuple(r)) for r in mine.select(*names).collect())
