"""``python -m logscope.jobs <levels|usage|events|daily> --in PATH --out DIR [...]``, or on a
cluster ``spark-submit --py-files logscope.zip logscope/jobs/__main__.py <job> ...``.

The master, cluster credentials and the shared ``spark.checkpoint.dir`` come
from spark-submit / the cluster configuration; nothing is baked in here.
"""

from __future__ import annotations

import argparse
import json

from logscope.session import ensure_checkpoint_dir, get_session
from logscope.sources import read_logs, read_period, read_files


def main(argv=None):
    p = argparse.ArgumentParser(prog="logscope.jobs")
    p.add_argument("job", choices=["levels", "usage", "events", "daily"])
    p.add_argument("--in", dest="inp", required=True, help="log root / parquet root or files")
    p.add_argument("--out", required=True, help="output folder (shared file system on a cluster)")
    p.add_argument("--master", default=None)
    p.add_argument("--skip-scan", action="store_true", help="usage: rebuild from the written timeline")
    p.add_argument("--year", type=int, default=2021)
    p.add_argument("--months", default="1-12", help="daily: month range within the year, e.g. 1-6")
    p.add_argument("--files", action="store_true", help="daily: --in is a comma list of parquet files")
    p.add_argument("--seed", type=int, default=None)
    p.add_argument("--crlf", action="store_true", help="levels: CRLF line ends in the CSVs (byte parity)")
    a = p.parse_args(argv)
    spark = get_session(a.master, app_name=f"logscope-{a.job}")
    ensure_checkpoint_dir(spark)
    if a.job == "levels":
        from logscope.jobs.levels import run_levels_job
        res = run_levels_job(spark, read_logs(spark, a.inp), a.out, seed=a.seed, crlf=a.crlf)
    elif a.job == "usage":
        from logscope.jobs.usage import run_usage_job
        logs = None if a.skip_scan else read_logs(spark, a.inp)
        res = run_usage_job(spark, logs, a.out, skip_scan=a.skip_scan)
    elif a.job == "events":
        from logscope.jobs.events import run_events_job
        res = run_events_job(spark, read_logs(spark, a.inp), a.out)
    else:
        from logscope.jobs.daily import run_daily_job
        if a.files:
            table = read_files(spark, *a.inp.split(","))
        else:
            lo, hi = (int(x) for x in a.months.split("-"))
            table = read_period(spark, a.inp, [a.year], range(lo, hi + 1))
        res = run_daily_job(spark, table, a.out, a.year)
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
