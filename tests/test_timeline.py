"""Family B: timeline, cluster summary, stats, histograms, inventory."""
import datetime as dt

from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.operators import timeline as TL
from logscope.sources import log_lines

from conftest import SF_MID


def test_fixture_counts(fixture_lines):
    t = TL.app_timeline(fixture_lines)
    assert t.count() == 15
    assert t.select("cluster_id").distinct().count() == 5
    assert TL.path_ids(fixture_lines).count() == 294
    assert t.filter(F.col("start_time") > F.col("end_time")).count() == 0


def test_path_first_equals_row_first(spark):
    logs = log_lines(spark, SF_MID)
    ts = C.log_time("line")
    naive = (logs.select(C.application_id("path").alias("application_id"), ts.alias("ts"))
             .filter((F.col("application_id") != "") & F.col("ts").isNotNull())
             .groupBy(C.cluster_id("application_id").alias("cluster_id"), "application_id",
                      C.app_number("application_id").alias("app_number"))
             .agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time")))
    fast = TL.app_timeline(logs, ordered=False)
    assert fast.exceptAll(naive).count() == 0 and naive.exceptAll(fast).count() == 0


def _tl(spark, rows):
    return spark.createDataFrame(rows, "cluster_id string, application_id string, app_number string, "
                                       "start_time timestamp_ntz, end_time timestamp_ntz")


T0 = dt.datetime(2017, 1, 1)


def test_text_order_and_ties(spark):
    lines = [("/x/application_1_10001/container_1_10001_01_000001.log", "17/01/01 00:00:00 INFO a"),
             ("/x/application_1_9999/container_1_9999_01_000001.log", "17/01/01 00:00:01 INFO a"),
             ("/x/application_2_0001/container_2_0001_01_000001.log", "17/01/01 00:00:02 INFO a"),
             ("/x/application_2_0002/container_2_0002_01_000001.log", "17/01/01 00:00:03 INFO a"),
             ("/x/application_0_0001/container_0_0001_01_000001.log", "no time here")]
    logs = spark.createDataFrame(lines, "path string, line string")
    t = TL.app_timeline(logs).collect()
    assert [r["app_number"] for r in t] == ["10001", "9999", "0001", "0002"]
    s = TL.cluster_summary(TL.app_timeline(logs, ordered=False)).collect()
    assert [(r["cluster_id"], r["num_applications"]) for r in s] == [("1", 2), ("2", 2)]
    st = TL.usage_stats(TL.cluster_summary(TL.app_timeline(logs, ordered=False))).first()
    assert (st["total_clusters"], st["total_applications"], st["avg_apps_per_cluster"]) == (2, 4, 2.0)


def test_usage_stats_empty(spark):
    st = TL.usage_stats(TL.cluster_summary(_tl(spark, []))).first()
    assert (st["total_clusters"], st["total_applications"], st["avg_apps_per_cluster"]) == (0, 0, 0.0)


def test_histogram_sums_to_n(spark):
    t = TL.app_timeline(log_lines(spark, SF_MID), ordered=False)
    n = TL.busiest_cluster_apps(t).count()
    h = TL.duration_histogram(t, 30).collect()
    assert len(h) == 30 and sum(r["count"] for r in h) == n and {r["n"] for r in h} == {n}
    assert [r["bin"] for r in h] == list(range(30))


def test_histogram_equal_values_one_bin(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "v double")
    h = TL.histogram(df, "v", 30).collect()
    assert h[0]["count"] == 3 and sum(r["count"] for r in h) == 3


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    h = TL.histogram(df, "v", 10).collect()
    assert h[-1]["count"] == 2 and sum(r["count"] for r in h) == 11


def test_busiest_cluster_tie_break(spark):
    rows = [("b", "application_b_1", "1", T0, T0 + dt.timedelta(minutes=3)),
            ("a", "application_a_1", "1", T0, T0 + dt.timedelta(minutes=1))]
    d = TL.busiest_cluster_apps(_tl(spark, rows)).collect()
    assert [(r["cluster_id"], r["duration_min"]) for r in d] == [("a", 1.0)]


def test_inventory(fixture_lines):
    inv = TL.app_inventory(fixture_lines).first()
    assert inv["num_applications"] == 15 and inv["num_files"] == 294
    top = TL.top_apps_by_files(fixture_lines, 5).collect()
    assert len(top) == 5 and top[0]["num_files"] >= top[-1]["num_files"]


def test_cluster_start_month(spark):
    rows = [("1485248649253", "application_1485248649253_0001", "0001", T0, T0)]
    r = TL.cluster_start_month(TL.cluster_summary(_tl(spark, rows))).first()
    assert r["start_month"] == "Jan 2017" and r["cluster_start"] == dt.datetime(2017, 1, 24, 9, 4, 9, 253000)


def test_summary_invariants(spark):
    t = TL.app_timeline(log_lines(spark, SF_MID), ordered=False)
    s = TL.cluster_summary(t)
    rows = s.collect()
    assert sum(r["num_applications"] for r in rows) == t.count() == 150
    assert [r["num_applications"] for r in rows] == sorted((r["num_applications"] for r in rows), reverse=True)
    st = TL.usage_stats(s).first()
    assert st["total_applications"] == 150 and st["total_clusters"] == 6 and st["avg_apps_per_cluster"] == 25.0
