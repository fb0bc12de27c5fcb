"""Checkpoint folder, stored tables, session zone."""
import datetime as dt
import os
import subprocess
import sys

from logscope.functions import columns as C
from logscope.session import clear_materialized, materialize


def test_times_do_not_depend_on_the_session_zone(spark):
    """17/03/12 02:30 does not exist in New York; the log says it, so it stays."""
    df = spark.createDataFrame([("17/03/12 02:30:00 INFO A: x",), ("2017-03-12 02:30:00,250 INFO A: x",),
                                ("17/13/41 25:61:00 INFO A: x",), ("none",)], "line string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r["ts"] for r in C.with_log_time(df, "line", "ts").collect()]
        anchored = [r["t"] for r in df.select(C.log_time("line", "anchored").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2017, 3, 12, 2, 30), dt.datetime(2017, 3, 12, 2, 30, 0, 250000), None, None]
    assert anchored == [dt.datetime(2017, 3, 12, 2, 30), None, None, None]


def test_only_own_tables_are_removed(spark):
    from logscope.session import checkpoint_dir
    t = materialize(spark.range(3))
    root = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "logscope-tables")
    other = os.path.join(root, "another-application")
    os.makedirs(other, exist_ok=True)
    assert t.count() == 3 and spark.sparkContext.applicationId in os.listdir(root)
    clear_materialized(spark)
    assert spark.sparkContext.applicationId not in os.listdir(root) and "another-application" in os.listdir(root)
    os.rmdir(other)


def test_fallback_folder_serves_materialize(tmp_path):
    """A session without spark.checkpoint.dir: the installed fallback is found by strict callers."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "from logscope.session import ensure_checkpoint_dir, materialize\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        ".getOrCreate()\n"
        "from logscope.session import checkpoint_dir\n"
        "assert not checkpoint_dir(s)\n"
        f"ensure_checkpoint_dir(s, r'{tmp_path}')\n"
        "assert materialize(s.range(4), strict=True).count() == 4\n"
        "s.stop()\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "conf").mkdir()         # no site settings
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"SPARK_CONF_DIR": str(tmp_path / "conf")}
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120, env=env)
    assert done.returncode == 0, done.stderr[-2000:]


def test_ids_above_9999_stay_apart(spark):
    from logscope.sources.fixture import log_lines_from_events
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), u, "view") for u in (7, 10001, 100011, 1000)],
                               "event_id long, ts timestamp_ntz, user_id long, event_type string")
    apps = log_lines_from_events(spark, ev).select(C.application_id("path").alias("a")).distinct().collect()
    assert len(apps) == 4


def _fallbacks(node) -> int:
    """Sum of the metric "number of sort fallback tasks" below a physical plan node."""
    metric = node.metrics().get("numTasksFallBacked")
    n = metric.get().value() if metric.isDefined() else 0
    children = node.children()
    return n + sum(_fallbacks(children.apply(i)) for i in range(children.size()))


def test_percentiles_do_not_fall_back_to_sorting(spark):
    """More groups in a task than Spark's default threshold (128), fewer than the profile's."""
    from logscope.operators import tasks as TK
    from logscope.plans.catalog import LINEITEM_SPEC
    from logscope.operators.daily import daily_summary
    from logscope.sources import log_events, read_table

    from conftest import SF_MID

    def run():
        daily = daily_summary(read_table(spark, SF_MID, "lineitem"), LINEITEM_SPEC, 1996, ordered=False)
        skew = TK.stage_skew(TK.task_lifecycle(log_events(spark, SF_MID)))
        out = []
        for df in (daily, skew):
            df.collect()
            out.append(_fallbacks(df._jdf.queryExecution().executedPlan()))
        return out

    key = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    raised = spark.conf.get(key)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert run() == [0, 0]
        spark.conf.set(key, "128")
        assert run()[0] > 0         # what the profile avoids
    finally:
        spark.conf.set(key, raised)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
