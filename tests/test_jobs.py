"""End-to-end jobs on a real log tree."""
import os

from logscope.jobs import run_daily_job, run_levels_job, run_usage_job
from logscope.operators.daily import DailySpec
from logscope.sources import read_logs, read_table

from conftest import SF_SMALL


def test_levels_job(spark, log_tree, tmp_path):
    out = run_levels_job(spark, read_logs(spark, log_tree), str(tmp_path), seed=3)
    assert open(out["counts"]).read().splitlines() == [
        "log_level,count", "INFO,749", "WARN,187", "ERROR,201", "DEBUG,63"]
    assert len(open(out["sample"]).read().splitlines()) == 11
    s = open(out["summary"]).read().splitlines()
    assert s[0] == "Total log lines processed: 1,262"
    assert s[1] == "Total lines with log levels: 1,200"
    assert s[2] == "Unique log levels found: 4"
    assert s[5] == "  INFO :        749 ( 62.42%)"
    assert s[8] == "  DEBUG:         63 (  5.25%)"


def test_usage_job_and_skip_scan(spark, log_tree, tmp_path):
    out = run_usage_job(spark, read_logs(spark, log_tree), str(tmp_path))
    tl = open(out["timeline"]).read().splitlines()
    assert tl[0] == "cluster_id,application_id,app_number,start_time,end_time" and len(tl) == 16
    stats = open(out["stats"]).read().splitlines()
    assert stats[0] == "Total unique clusters: 5" and stats[1] == "Total applications: 15"
    assert stats[2] == "Average applications per cluster: 3.00"
    assert len(stats) == 5 + 5
    h = open(out["histogram"]).read().splitlines()
    assert len(h) == 31
    import csv
    from logscope.operators import timeline as TL
    want = {r["application_id"]: r["duration_min"] for r in TL.busiest_cluster_apps(
        TL.app_timeline(read_logs(spark, log_tree))).collect()}
    got = {r["application_id"]: float(r["duration_min"]) for r in csv.DictReader(open(out["durations"]))}
    assert got == want and any(v * 60 % 1 for v in want.values())      # sub-second times are kept
    again = run_usage_job(spark, None, str(tmp_path), skip_scan=True)
    assert open(again["cluster_summary"]).read() == open(out["cluster_summary"]).read()


def test_daily_job(spark, tmp_path):
    spec = DailySpec(ts="o_orderdate", count_name="num_orders", mean=("o_totalprice", "mean_price"),
                     max=("o_totalprice", "max_price"), q95=("o_totalprice", "q95_price"),
                     min=("o_totalprice", "min_price"), ceil_mean=("o_custkey", "ceil_mean_custkey"))
    out = run_daily_job(spark, read_table(spark, SF_SMALL, "orders"), str(tmp_path), 1996, spec)
    rows = open(out["daily"]).read().splitlines()
    assert rows[0].startswith("dt_year,dt_month,dt_day,num_orders")
    assert rows[1].startswith("1996,12,")
    rep = open(out["report"]).read().splitlines()
    assert rep[0].startswith("Days with data: ") and os.path.exists(out["daily"])


def test_events_job_reads_the_logs_once(spark, log_tree, tmp_path):
    from logscope.jobs import run_events_job
    tree = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(log_tree) for f in fs if f.endswith(".log"))
    b0 = _bytes_read(spark)
    from logscope.operators import events as EV
    EV.event_table(read_logs(spark, log_tree))
    assert 1.0 <= (_bytes_read(spark) - b0) / tree < 1.3
    out = run_events_job(spark, read_logs(spark, log_tree), str(tmp_path))
    assert len(out) == 19 and spark.read.option("header", True).csv(out["task_lifecycle"]).count() == 288


def test_single_file_writer_does_not_narrow_the_aggregate(spark, log_tree):
    """Below the one writer there is an exchange, so the aggregate keeps its own tasks."""
    from logscope.operators import timeline as TL
    plan = TL.app_timeline(read_logs(spark, log_tree), ordered=False).repartition(1)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange SinglePartition") < plan.index("HashAggregate")


def _bytes_read(spark):
    st = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    return st.getLong("bytesRead") if st is not None else 0


def test_jobs_read_the_logs_once(spark, log_tree, tmp_path):
    """Bytes read from the local file system per job, relative to the log tree:
    both jobs scan the lines once (plus their own small written outputs)."""
    tree = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(log_tree) for f in fs
               if f.endswith(".log"))
    b0 = _bytes_read(spark)
    run_usage_job(spark, read_logs(spark, log_tree), str(tmp_path / "u"))
    b1 = _bytes_read(spark)
    run_levels_job(spark, read_logs(spark, log_tree), str(tmp_path / "l"))
    b2 = _bytes_read(spark)
    assert 1.0 <= (b1 - b0) / tree < 1.5
    assert 1.0 <= (b2 - b1) / tree < 1.3
