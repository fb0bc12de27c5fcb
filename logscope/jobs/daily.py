"""Family C job: per-day summary of a period, CSV plus period report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logscope.jobs.parallel import run_all
from logscope.operators import daily as DY
from logscope.operators import reports as RP
from logscope.session import materialize
from logscope.sinks import write_csv, write_text


def run_daily_job(spark: SparkSession, table: DataFrame, outdir: str, year: int,
                  spec: DY.DailySpec = DY.TRIP_SPEC) -> dict[str, str]:
    out = outdir.rstrip("/")
    daily = materialize(DY.daily_summary(table, spec, year, ordered=False), strict=True)
    totals = DY.period_totals(daily, spec.count_name)
    daily_csv, report = run_all(
        lambda: write_csv(daily, f"{out}/daily_summary.csv",
                          order_by=[daily.dt_year.desc(), daily.dt_month.desc(), daily.dt_day.desc()]),
        lambda: write_text(RP.period_report(totals, spec.count_name), f"{out}/daily_report.txt",
                           order_by="line_no"))
    return {"daily": daily_csv, "report": report}
