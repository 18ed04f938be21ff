from dataclasses import fields

from sublens.plans import fused
from sublens.plans.report import daily_report
from sublens.sources import fixtures
from sublens.sources.tables import COLUMNS, Sources

SF = "/root/testdata/sf0.001"


def test_parquet_sources_prune_push_and_agree(spark, tmp_path):
    src = fixtures.load(spark, SF)
    for f in fields(src):
        getattr(src, f.name).write.parquet(str(tmp_path / f.name))
    back = Sources.from_parquet_dir(spark, str(tmp_path))
    for f in fields(back):
        assert getattr(back, f.name).columns == COLUMNS[f.name]
    ctx = fixtures.fixture_context()
    plan = fused.horizon_slice(back, ctx)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(Or(GreaterThanOrEqual(service_end_date" in plan
    a = sorted(tuple(r) for r in daily_report(back, ctx).collect())
    b = sorted(tuple(r) for r in daily_report(src, ctx).collect())
    assert a == b


def test_catalog_sources_agree(spark):
    src = fixtures.load(spark, SF)
    names = {}
    for f in fields(src):
        view = f"cat_{f.name}"
        getattr(src, f.name).createOrReplaceTempView(view)
        names[f.name] = view
    back = Sources.from_catalog(spark, names)
    ctx = fixtures.fixture_context()
    a = sorted(tuple(r) for r in daily_report(back, ctx).collect())
    b = sorted(tuple(r) for r in daily_report(src, ctx).collect())
    assert a == b
