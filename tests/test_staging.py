"""A run's stages lie in one folder with a manifest, and nothing is left of them."""

import json
import os

import pytest

import sublens.__main__ as cli
from sublens.plans.report import daily_report
from sublens.session import checkpoint_dir
from sublens.sources import fixtures
from sublens.sources.sink import read_report
from sublens.sources.staging import MANIFEST, PREFIX, RunFolder, sweep

SF = "/root/testdata/sf0.001"


def folders(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    return [f for f in os.listdir(base) if f.startswith(PREFIX)]


def test_stages_are_projected_listed_and_removed(spark):
    src, ctx = fixtures.load(spark, SF), fixtures.fixture_context()
    want = [tuple(r) for r in daily_report(src, ctx).collect()]
    with RunFolder(spark) as run:
        got = [tuple(r) for r in daily_report(src, ctx, run=run).collect()]
        with open(f"{run.path.removeprefix('file:')}/{MANIFEST}") as f:
            listed = json.load(f)["stages"]
        assert [s["path"].rsplit("-", 1)[0] and s["columns"] for s in listed] == [s["columns"] for s in run.stages]
        names = {os.path.basename(s["path"])[3:] for s in listed}
        assert {"slice", "history", "owners", "subscribers", "attribution", "vip", "viewer-days"} <= names
        assert 0 < run.bytes < sum(os.path.getsize(f"{SF}/{t}.parquet") for t in ("orders", "customer", "events"))
        assert not any("evergent_order_id" in s["columns"] for s in listed if s["path"].endswith("slice"))
    assert got == want
    assert folders(spark) == []


def test_nothing_is_left_by_the_command_line(spark, tmp_path, monkeypatch):
    cli.main(["--sources", SF, "--driver-tables", "--today", "2024-01-31", "--out", str(tmp_path / "r")])
    assert read_report(spark, str(tmp_path / "r")).count() == 49
    assert folders(spark) == []

    def broken(*a, **k):
        assert folders(spark)
        raise RuntimeError("the sink is away")
    monkeypatch.setattr(cli, "write_report", broken)
    with pytest.raises(RuntimeError):
        cli.main(["--sources", SF, "--driver-tables", "--today", "2024-01-31", "--out", str(tmp_path / "s")])
    assert folders(spark) == []


def test_sweep_removes_what_is_left_of_dead_runs(spark):
    run = RunFolder(spark)
    assert run.stage(spark.range(3), "x").count() == 3
    assert sweep(spark, hours=1) == [] and len(folders(spark)) == 1
    assert len(sweep(spark, hours=-1)) == 1 and folders(spark) == []
