"""SURVEY §5.4: for several report dates the fused single-pass report equals
the per-measure plans (driver tables, sf0.001)."""

import datetime as dt

import pytest

from sublens.plans.report import daily_report
from sublens.sources import fixtures

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("today", [dt.date(2024, 1, 12), dt.date(2024, 1, 24),
                                   dt.date(2024, 2, 15)])
def test_fused_equals_per_measure(spark, today):
    src, ctx = fixtures.load(spark, SF), fixtures.fixture_context(today)
    fused = sorted(tuple(r) for r in daily_report(src, ctx, "fused").collect())
    separate = sorted(tuple(r) for r in daily_report(src, ctx, "per_measure").collect())
    assert fused == separate
    assert len(fused) >= 38
