"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_harness import compare, duck

from kinora.plans.registry import QUERIES

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["movie_id", "rank", "popularity_score"] and df.count() > 0


def test_every_query_has_oracle():
    """Those of the catalogue part; some of the optional subpackage have tests instead."""
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    res = compare(df, con, E.oracle_sql()[key])
    assert res["ok"], res
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], f"{key}: all-pairs join operator in plan"


def test_rating_scan_is_pruned_and_filtered(spark):
    plan = E.queries()["clean_ratings"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "lineitem.parquet" in line][0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_tax:double>" in scan
    assert "PushedFilters: [IsNotNull(l_orderkey)" in scan
