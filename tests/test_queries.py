import pytest

import __spark_entry__ as entry
from panelcast import queries as registered


def test_every_query_has_sql():
    queries, sql = registered.load()
    assert set(sql) == set(queries)


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns[:2] == ["area", "consumer_type"] and got.count() == 16


#: User functions and the recursion of forecasts; those that write tables and start streams are jobs, not plans.
APART = ("k0", "o01", "o03", "a", "m0", "n0", "g02")


@pytest.mark.parametrize("name", sorted(n for n in registered.load()[0] if not n.startswith(APART)))
def test_plans_stay_in_the_jvm_and_off_a_single_task(spark, name):
    """No Python, no cross product; rows come together in one task only as partial results or a sorted list of keys."""
    df = entry.queries()[name](spark, entry.SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan, unwanted
    lines = plan.split("== Initial Plan ==")[-1].splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "".join(lines[i + 1:i + 3])
            assert "partial_" in below or "Limit" in below or "HashAggregate" in below, below
