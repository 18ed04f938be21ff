"""Run the daily report.

    python -m sublens --sources /data/report_inputs --today 2024-01-31 \\
        [--plan fused|per_measure|sql] [--out /data/daily_report]

``--sources`` is a folder with one Parquet table per input (``dim_service``,
``dim_date``, ``dim_account``, ``dim_content``, ``fact_engagement``,
``test_accounts``, ``vip``, ``ev_op_promotions``, ``ev_promotions``,
``ev_ordered_product``, ``ev_account``, ``ev_account_status``); with
``--driver-tables`` it is a folder of the driver's generated tables, mapped by
``sources.fixtures``.  Without ``--out`` the rows are printed.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from sublens.context import ReportContext, parse_date
from sublens.plans.report import daily_report
from sublens.sources import fixtures
from sublens.sources.sink import write_report
from sublens.sources.staging import RunFolder
from sublens.sources.tables import Sources


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="sublens", description=__doc__.split("\n")[0])
    ap.add_argument("--sources", required=True)
    ap.add_argument("--today", default=None,
                    help="T; the report describes T - 1 (default: today, UTC)")
    ap.add_argument("--plan", choices=["fused", "per_measure", "sql"], default="fused")
    ap.add_argument("--out", default=None)
    ap.add_argument("--driver-tables", action="store_true")
    args = ap.parse_args(argv)

    today = parse_date(args.today) if args.today else dt.datetime.now(dt.timezone.utc).date()
    spark = SparkSession.builder.appName("sublens").getOrCreate()
    if args.driver_tables:
        src, ctx = fixtures.load(spark, args.sources), fixtures.fixture_context(today)
    else:
        src, ctx = Sources.from_parquet_dir(spark, args.sources), ReportContext(today=today)
    with RunFolder(spark) as run:            # gone at the end, also of a run that fails
        report = daily_report(src, ctx, plan=args.plan, run=run)
        if args.out:
            write_report(report, args.out)
        else:
            for row in report.collect():
                print(f"{row['date']}\t{row['order']}\t{row['measure']}\t{row['value']}")


if __name__ == "__main__":
    main()
