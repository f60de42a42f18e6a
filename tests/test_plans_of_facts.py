"""How the plans of facts deal out their rows."""

import re

import pytest

import starload.queries.all  # noqa: F401
from starload.queries.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name, code",
    [
        ("fact_measure_bridge", "origem"),
        ("fact_projeto_investimento_fonte_recurso", "origem"),
    ],
)
def test_rows_are_not_shuffled_by_the_keys_of_a_small_dimension(spark, name, code):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert f"BroadcastHashJoin [{code}" in plan and f"hashpartitioning({code}" not in plan


def test_funding_rows_are_not_sorted_for_a_sum(spark):
    plan = QUERIES["fact_projeto_investimento"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[idunico" in plan and not re.search(r"SortAggregate\(key=\[idunico#\d+, origem", plan)
