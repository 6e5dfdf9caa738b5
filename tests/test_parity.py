"""Every query of the library against its DuckDB oracle on the smallest driver tables (the
queries of the llm subpackage have their own tests)."""

import pytest

from __spark_entry__ import entry
from strata.plans.oracle import oracle_sql
from strata.plans.registry import queries


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["year", "month", "revenue", "order_count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, sf_small, name):
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from compare_oracle import compare
    rep = compare(spark, sf_small, [name])[name]
    assert "error" not in rep, rep
    assert rep["columns"] and rep["types"] and rep["values"], rep


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_plan_shape(spark, sf_small, name):
    """Every query scans the driver tables (or files / checkpoints Spark wrote from
    them), so its work grows with them, and none runs on generated rows alone; no
    plan has a cross / nested-loop join or evaluates Python per row."""
    plan = queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert any(s in plan for s in ("Scan parquet", "FileScan parquet", "FileScan csv",
                                   "Scan csv", "JDBCRelation", "Scan ExistingRDD")), plan[:2000]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython"):
        assert bad not in plan, (bad, plan[:2000])
