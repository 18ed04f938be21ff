import datetime as dt

from builders import World
from sublens.context import ReportContext
from sublens.plans.report import daily_report
from sublens.sources.sink import read_report, write_report


def test_dynamic_overwrite_keeps_other_days(spark, tmp_path):
    w = World()
    w.service(1, "2024-01-25", "2024-02-20", method="FREE TRIAL")
    src = w.sources(spark)
    path = str(tmp_path / "report")
    for today in (dt.date(2024, 1, 26), dt.date(2024, 1, 27)):
        write_report(daily_report(src, ReportContext(today=today)), path)
    write_report(daily_report(src, ReportContext(today=dt.date(2024, 1, 27))), path)
    back = read_report(spark, path)
    per_day = {r["date"]: r["n"] for r in back.groupBy("date").count()
               .withColumnRenamed("count", "n").collect()}
    # the trial started on 01-25: both days also emit "New Trialists L7D"
    assert per_day == {dt.date(2024, 1, 25): 39, dt.date(2024, 1, 26): 39}
    first = {r["date"]: r["value"] for r in back.where("`order` = 1").collect()}
    assert first == {dt.date(2024, 1, 25): 1, dt.date(2024, 1, 26): 0}
