"""All registered queries against their SQL, and the shape of their plans."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare

# The training-data operators have tests of their own.
EXTRA = {*entry.llm.queries(), "pipeline"} if entry.llm else set()
QUERIES = {n: q for n, q in entry.queries().items() if n not in EXTRA}
ORACLE = {n: q for n, q in entry.oracle_sql().items() if n not in EXTRA}
TRAINED = {"lead_scores", "lead_importance", "lead_permutation_importance", "lead_hold_out", "lead_cross_validation"}
# Have SQL, but train at full length; test_scoring.py holds them for a short run.
LONG = {"lead_model_checks", "lead_saved_model"}
# Applies a map of numbers by Arrow batches.
ARROW = {"lead_calibration"}


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def test_every_query_has_sql_but_the_trained_ones():
    assert set(QUERIES) - set(ORACLE) == TRAINED


@pytest.mark.parametrize("name", sorted(set(ORACLE) - LONG))
def test_same_as_sql(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    cur = con.execute(ORACLE[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cur.description], cur.fetchall()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINED - LONG - ARROW))
def test_plan_stays_in_the_jvm_without_cross_joins(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_filter_and_columns_reach_the_scan(spark, folder):
    plan = QUERIES["cancel_by_payment"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan
    assert "struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_event_days_reach_the_scan(spark, folder):
    plan = QUERIES["latest_block"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_ranks_are_limited_before_the_shuffle(spark, folder):
    plan = QUERIES["top_sellers"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["branch", "kind", "section"] and df.count() > 0
