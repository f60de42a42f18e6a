"""Every registered query against its SQL, on the smallest tables."""

import pytest

import starload.queries.all  # noqa: F401
from starload.queries.check import compare, connect
from starload.queries.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert name in ORACLES
    assert compare(spark, duck, FOLDER, name) is None


LAZY = ["upsert", "dedupe_first", "fact_main", "fact_measure_bridge", "bridge_part", "delete_children_by_parent"]


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_cross_join_and_pushes_columns(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # only the totals of the buckets and the greatest key in use meet in one task
    for line in plan.splitlines():
        if "SinglePartition" in line:
            below = plan[plan.index(line) + len(line) :].splitlines()[1]
            assert "HashAggregate" in below or "_bucket" in below, below


def test_filters_reach_the_scan(spark):
    plan = QUERIES["upsert"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_shipdate" in plan and "GreaterThanOrEqual(l_shipdate" in plan
    assert "l_comment" not in plan and "l_discount" not in plan


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert QUERIES.keys() == ORACLES.keys()
    assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= ORACLES.keys()
    assert entry.entry(spark).columns == ["sk_projeto_investimento", "sk_eixo"]
