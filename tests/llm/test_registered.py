"""The registered queries that SQL can express, side by side with it."""

import oracle_check
import pytest

from matchstats.llm.queries import registered, registered_sql

SF = "/root/testdata/sf0.001"


def test_names():
    assert set(registered_sql()) <= set(registered())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in registered()) == 1


@pytest.mark.parametrize("name", sorted(registered_sql()))
def test_query_equals_sql(spark, name):
    assert oracle_check.difference(spark, oracle_check.connect(SF), name, SF) is None


@pytest.mark.parametrize("name", ["op6_benchmark_decontamination", "op9_secret_scans", "op13_source_mixing"])
def test_native_plans_have_no_python(spark, name):
    text = registered()[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in text for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
