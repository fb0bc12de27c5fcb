"""Text and parquet sources on real files, sinks and result round trips."""
import datetime as dt
import os

from pyspark.sql import functions as F

from logscope.operators import levels as LV
from logscope.operators import timeline as TL
from logscope.sinks import write_csv, write_text
from logscope.sources import (profile_source, read_logs, read_logs_numbered, read_period, read_table,
                              read_timeline)

from conftest import SF_SMALL


def test_recursive_text_scan_matches_fixture(spark, log_tree, fixture_lines):
    logs = read_logs(spark, log_tree)
    assert logs.count() == 1262
    assert LV.level_counts(logs).collect() == LV.level_counts(fixture_lines).collect()
    a = {(r["application_id"], r["start_time"], r["end_time"]) for r in TL.app_timeline(logs).collect()}
    b = {(r["application_id"], r["start_time"], r["end_time"]) for r in TL.app_timeline(fixture_lines).collect()}
    assert a == b
    assert TL.app_inventory(logs).first()["num_files"] == 294


def test_file_size_from_metadata(spark, log_tree, fixture_lines):
    a = TL.app_inventory(read_logs(spark, log_tree)).first()
    b = TL.app_inventory(fixture_lines).first()
    assert a["max_app_bytes"] == b["max_app_bytes"] and a["min_app_bytes"] == b["min_app_bytes"]


def test_glob_and_application_filter(spark, log_tree):
    apps = read_logs(spark, log_tree).select(F.regexp_extract("path", r"(application_\d+_\d+)", 1)).distinct()
    one = apps.first()[0]
    g = read_logs(spark, f"{log_tree}/logs/application_*/*.log", recursive=False)
    assert g.count() == 1262
    s = read_logs(spark, log_tree, applications=[one])
    assert s.select(F.regexp_extract("path", r"(application_\d+_\d+)", 1)).distinct().collect()[0][0] == one


def test_numbered_lines_keep_file_order(spark, log_tree, fixture_lines):
    n = read_logs_numbered(spark, log_tree)
    assert n.count() == 1262
    first = n.filter("line_no = 0").count()
    assert first == 294
    got = [r["line"] for r in n.filter(F.col("path").endswith(
        "container_1440487435730_0019_01_000001.log")).orderBy("line_no").collect()]
    want = [r["line"] for r in fixture_lines.filter(F.col("path").endswith(
        "container_1440487435730_0019_01_000001.log")).orderBy("line_no").collect()]
    assert got == want


def test_zero_byte_and_crlf_files(spark, tmp_path):
    d = tmp_path / "application_1_0001"
    d.mkdir()
    (d / "container_1_0001_01_000001.log").write_bytes(b"")
    (d / "container_1_0001_01_000002.log").write_bytes(b"17/01/01 00:00:00 INFO a\r\nb\r\n")
    logs = read_logs(spark, str(tmp_path))
    assert sorted(r["line"] for r in logs.collect()) == ["17/01/01 00:00:00 INFO a", "b"]
    n = read_logs_numbered(spark, str(tmp_path))
    assert [(r["line_no"], r["line"]) for r in n.orderBy("line_no").collect()] == [
        (0, "17/01/01 00:00:00 INFO a"), (1, "b")]


def test_read_period_prunes_months(spark, tmp_path):
    orders = read_table(spark, SF_SMALL, "orders")
    for m in (1, 2, 3):
        part = tmp_path / "yyyy=2021"
        orders.filter(F.month("o_orderdate") == m).coalesce(1).write.mode("overwrite").parquet(
            str(part / f"_m{m}"))
        f = [x for x in os.listdir(part / f"_m{m}") if x.endswith(".parquet")][0]
        os.rename(part / f"_m{m}" / f, part / f"trips_2021-{m:02d}.parquet")
    p = read_period(spark, str(tmp_path), [2021], [1, 2])
    assert "yyyy" in p.columns
    assert p.count() == orders.filter(F.month("o_orderdate").isin(1, 2)).count()
    # the partition column prunes directories
    whole = spark.read.parquet(str(tmp_path)).filter(F.col("yyyy") == 2021)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyy" in plan and "(yyyy" in plan


def test_profile(spark):
    prof = {r["column_name"]: (r["data_type"], r["num_rows"], r["num_nulls"])
            for r in profile_source(read_table(spark, SF_SMALL, "nation")).collect()}
    assert prof["n_name"][0] == "string" and prof["n_name"][1] == 25


def test_csv_round_trip_keeps_text_ids(spark, tmp_path):
    rows = [("1485248649253", "application_1485248649253_0052", "0052",
             dt.datetime(2017, 3, 29, 10, 4, 41), dt.datetime(2017, 3, 29, 10, 5, 0, 500000))]
    df = spark.createDataFrame(rows, "cluster_id string, application_id string, app_number string, "
                                     "start_time timestamp_ntz, end_time timestamp_ntz")
    path = str(tmp_path / "timeline.csv")
    write_csv(df, path)
    text = open(path).read().splitlines()
    assert text[0] == "cluster_id,application_id,app_number,start_time,end_time"
    assert text[1] == "1485248649253,application_1485248649253_0052,0052,2017-03-29 10:04:41.000,2017-03-29 10:05:00.500"
    back = read_timeline(spark, path).first()
    assert back["app_number"] == "0052" and back["start_time"] == dt.datetime(2017, 3, 29, 10, 4, 41)


def test_empty_frame_header_only(spark, tmp_path):
    df = spark.createDataFrame([], "log_level string, count long")
    path = str(tmp_path / "empty.csv")
    write_csv(df, path)
    assert open(path).read().strip() == "log_level,count"


def test_csv_quoting_and_crlf(spark, tmp_path):
    df = spark.createDataFrame([('a, "b"', "INFO")], "log_entry string, log_level string")
    path = str(tmp_path / "s.csv")
    write_csv(df, path, line_sep="\r\n")
    assert open(path, newline="").read() == 'log_entry,log_level\r\n"a, ""b""",INFO\r\n'


def test_write_text_ordered(spark, tmp_path):
    df = spark.createDataFrame([(2, "c"), (0, "a"), (1, "b")], "line_no int, text string")
    path = str(tmp_path / "r.txt")
    write_text(df, path, order_by="line_no")
    assert open(path).read().splitlines() == ["a", "b", "c"]


def test_concat_frames_and_matching_lines(spark, tmp_path, fixture_lines):
    from logscope.sinks import write_matching_lines
    from logscope.sources import concat_frames
    a = spark.createDataFrame([("p", "INFO x")], "path string, line string")
    b = spark.createDataFrame([("q", 3, "ERROR y")], "path string, line_no int, line string")
    u = concat_frames(a, b)
    assert u.columns == ["path", "line", "line_no"] and u.count() == 2
    out = write_matching_lines(fixture_lines, "ERROR", str(tmp_path / "errors"))
    got = spark.read.text(out).count()
    assert got == fixture_lines.filter(F.col("line").contains("ERROR")).count()


def test_range_and_sql_surface(spark):
    from logscope.plans.views import even_doubled, register, row_count
    v = register(spark.range(1000), "range_test")
    assert row_count(spark, v).first()["total"] == 1000
    d = even_doubled(spark, v, "id")
    assert d.count() == 500 and d.agg(F.max("doubled")).first()[0] == 1996


def test_numbers_do_not_depend_on_splits(spark, log_tree, tmp_path):
    """Many splits per file give the numbers of one split; a lone CR ends a line in both readers."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = sorted(map(tuple, read_logs_numbered(spark, log_tree).select("path", "line_no", "line").collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        a = read_logs_numbered(spark, log_tree)
        assert a.rdd.getNumPartitions() > 294
        assert sorted(map(tuple, a.select("path", "line_no", "line").collect())) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "a.log").write_bytes(b"x\ry\r\nz")
    assert [(r["line_no"], r["line"]) for r in read_logs_numbered(spark, str(tmp_path)).orderBy("line_no").collect()] == [
        (0, "x"), (1, "y"), (2, "z")]


def test_listing_reads_no_content_and_finds_skipped_files(spark, log_tree, tmp_path):
    import shutil

    from logscope.sources import list_logs, unread_files
    listing = list_logs(spark, log_tree)
    plan = listing._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]
    a, b = TL.app_inventory(listing).first(), TL.app_inventory(read_logs(spark, log_tree)).first()
    assert a == b
    before = _bytes_read(spark)
    TL.app_inventory(list_logs(spark, log_tree)).collect()
    assert _bytes_read(spark) == before
    d = tmp_path / "application_1_0001"
    shutil.copytree(log_tree, tmp_path / "logs")
    d.mkdir()
    (d / "container_1_0001_01_000002.log.gz").write_bytes(b"this is not gzip data")
    (d / "container_1_0001_01_000003.log").write_bytes(b"")
    lost = unread_files(read_logs(spark, str(tmp_path)), list_logs(spark, str(tmp_path))).collect()
    assert [os.path.basename(r["path"]) for r in lost] == ["container_1_0001_01_000002.log.gz"]


def _bytes_read(spark):
    st = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    return st.getLong("bytesRead") if st is not None else 0


def test_period_passes_over_absent_months(spark, tmp_path):
    import pytest
    spark.range(3).write.parquet(str(tmp_path / "yyyy=2021" / "trips-02.parquet"))
    assert read_period(spark, str(tmp_path), [2021], range(1, 13)).count() == 3
    with pytest.raises(FileNotFoundError):
        read_period(spark, str(tmp_path), [2020], range(1, 13))


def test_profile_of_odd_column_names(spark):
    df = spark.createDataFrame([(1, None)], "`it's` int, `a``b` string")
    assert sorted((r["column_name"], r["num_nulls"]) for r in profile_source(df).collect()) == [("a`b", 1), ("it's", 0)]


def test_half_written_corpus_is_replaced(spark, tmp_path):
    from logscope.sources.fixture import _publish
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(str(tmp_path)).getFileSystem(spark._jsc.hadoopConfiguration())
    spark.range(5).write.parquet(str(tmp_path / "new"))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-00000.parquet").write_bytes(b"half")
    _publish(fs, jvm, str(tmp_path / "new"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_corrupt_file_is_skipped(spark, tmp_path):
    d = tmp_path / "application_1_0001"
    d.mkdir()
    (d / "container_1_0001_01_000001.log").write_text("17/01/01 00:00:00 INFO ok\n")
    (d / "container_1_0001_01_000002.log.gz").write_bytes(b"this is not gzip data")
    logs = read_logs(spark, str(tmp_path))
    assert [r["line"] for r in logs.collect()] == ["17/01/01 00:00:00 INFO ok"]
    import pytest
    with pytest.raises(Exception):
        read_logs(spark, str(tmp_path), ignore_corrupt=False).collect()


def test_sql_over_registered_log_views(spark, fixture_lines):
    from logscope.plans.views import register_log_views
    v = register_log_views(fixture_lines)
    by_sql = spark.sql(f"SELECT level, count(*) AS n FROM {v['log_records']} WHERE level <> '' GROUP BY level")
    assert dict(by_sql.collect()) == {r["log_level"]: r["count"] for r in LV.level_counts(fixture_lines).collect()
                                      if r["count"] > 0}
    top = spark.sql(f"SELECT cluster_id FROM {v['cluster_summary']} ORDER BY num_applications DESC, cluster_id "
                    "LIMIT 1").first()[0]
    assert top == TL.top_clusters(TL.cluster_summary(TL.app_timeline(fixture_lines)), 1).first()["cluster_id"]
    n = spark.sql(f"SELECT count(*) FROM {v['app_timeline']}").first()[0]
    assert n == 15


def test_stitching_on_numbered_text_files(spark, log_tree, fixture_lines):
    """S13 + L16 on real files, cut into many splits and blocks of 8 line numbers: per
    file, the entries' texts equal those of the fixture (line numbers differ: per file
    there, global in the fixture)."""
    from logscope.operators.records import stitched_entries

    def entries(df, **kw):
        per_file = {}
        for r in stitched_entries(df, **kw).collect():
            per_file.setdefault(r["path"].split("/logs/")[1], []).append((r["has_header"], r["num_lines"], r["entry_text"]))
        return {p: sorted(ts) for p, ts in per_file.items()}

    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")      # many splits per file
    try:
        a = entries(read_logs_numbered(spark, log_tree), block_lines=8)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    b = entries(fixture_lines)
    assert a == b and len(a) == 294
