"""Every registered query against its SQL on the given tables, and properties of the plans."""

import re

import pytest

import __spark_entry__ as entry
import check
from twinledger.operators.keys import key_profile, key_summary
from twinledger.queries import load, registry

from conftest import SMALL

load()

# These collect small results on the way: the plan that is left says nothing.
NO_PLAN = ("ladder",)
# What no SQL is given for.
WITHOUT_SQL = {"ladder_model_tiers"}


@pytest.fixture(scope="module")
def duck():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_agrees_with_sql(spark, duck, name):
    """Same rows as the SQL; no products of tables and no Python in the plan."""
    df = entry.queries()[name](spark, SMALL)
    if not name.startswith(NO_PLAN):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas", plan)
    status, rows, why = check.compare(spark, duck, name, SMALL, df)
    assert status == ("rows only" if name in WITHOUT_SQL else "ok"), why


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["col_name", "ordinal", "shared", "mismatches", "residual"] and df.count() == 5


def test_checks_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scans_read_only_what_is_compared(spark):
    df = entry.queries()["key_diff"](spark, SMALL)
    scans = re.findall(r"ReadSchema: struct<([^>]*)", df._jdf.queryExecution().executedPlan().toString())
    assert "o_orderkey:bigint" in scans


def test_one_shuffle_for_counts_and_keys(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    plan = key_summary(key_profile(orders, orders.limit(10), ["o_orderkey"]), ["o_orderkey"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text and "partial_count" in text
