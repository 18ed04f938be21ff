"""Scale properties of the fused plan, checked on its physical plans."""

import re

from sublens.plans import fused
from sublens.plans.cohorts import Cohorts
from sublens.sources import fixtures

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fused_plan_shape(spark):
    src, ctx = fixtures.load(spark, SF), fixtures.fixture_context()
    report = fused.fused_report(src, ctx)
    report.collect()
    plan = _plan(report)
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # nested loops only between calendar-sized tables (the next-calendar-day helper)
    assert len(re.findall("BroadcastNestedLoopJoin", plan)) <= 2
    # the final query reads the service source only through checkpoints:
    # its scans of `orders` are the VIP-list inputs of the fixture mapping
    # (ev_op_promotions and ev_ordered_product project `orders`), not dim_service
    assert "o_orderpriority" not in plan


def test_service_table_passes(spark):
    """Pass 1 and pass 2 each read the service table once."""
    src, ctx = fixtures.load(spark, SF), fixtures.fixture_context()
    base = Cohorts(src, ctx, staged=True)
    co = Cohorts(src, ctx, service_rows=base.stage(fused.horizon_slice(src, ctx)), staged=True)
    history = fused.keyed_history(co)
    plan = _plan(history)
    # one scan of the service source (the key sets come from the checkpointed slice)
    assert len(re.findall(r"o_orderpriority", plan)) >= 1
    assert len(re.findall(r"FileScan parquet \S*\[o_orderkey\S*,o_custkey\S*,o_orderstatus", plan)) == 1
