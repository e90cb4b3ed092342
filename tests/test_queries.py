"""Every named query against its SQL twin, and checks of the physical plans."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry
from check_queries import TABLES, compare

from shopstrata.plans.oracles import SQL
from shopstrata.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR)[2] == "ok"


def plan(spark, name: str) -> str:
    return entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join_in_any_plan(spark, name):
    text = plan(spark, name)
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, word


def test_scans_are_pruned_and_filters_pushed(spark):
    text = entry.queries()["shop_daily"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" in text and "c_acctbal" not in text and "c_mktsegment" not in text
    recent = plan(spark, "ops_dq_failures")
    assert "PushedFilters: [IsNotNull(" in recent and "GreaterThanOrEqual(ts" in recent


def test_letters_and_items_are_computed_once(spark):
    for name in ("dead_letters", "accepted_items", "explode_items"):
        for node in plan(spark, name).splitlines():
            assert not ("Filter" in node and "size(" in node), name


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "gmv_dod_pct" in df.columns and df.count() > 0
