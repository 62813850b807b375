"""The registered queries against their SQL twins on the smallest tables, and their plans."""

from __future__ import annotations

import os
import re
import sys

import pytest
from plans import plan_text

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import differences, duck  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
# loads, tables and feeds write a lot; their operators have tests of their own
LAZY = sorted(n for n, q in queries().items() if q.__module__.rsplit(".", 1)[-1] in ("incremental", "scans", "shapes"))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) >= {n for n, q in queries().items() if q.__module__.startswith("workload")}


@pytest.mark.parametrize("name", LAZY)
def test_query_agrees_and_scales(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    plan = plan_text(df)
    # no side compared row by row with the other, no window in a single task, no Python per row
    assert not re.search(r"CartesianProduct|NestedLoop|Window\b|BatchEvalPython", plan)
    assert differences(df.toPandas(), con.sql(oracle_sql()[name]).df()) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["k", "event_type", "n_rows", "last_id", "_data_source", "_source_type", "_qtd_rows"]
    assert df.count() > 0


def test_queries_may_run_twice(spark):
    for name in ("copy_into_idempotent", "ledger_driven_load"):
        first, second = (queries()[name](spark, SF_DIR).count() for _ in range(2))
        assert first == second > 0
