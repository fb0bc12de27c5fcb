"""Edge corpus: hand-written lines with expected level (both modes), level
occurrences, time and component."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from logscope.functions import columns as C

T = dt.datetime
CORPUS = [
    ("17/03/29 10:04:41 INFO ApplicationMaster: Registered signal handlers", "INFO", "INFO", 1,
     T(2017, 3, 29, 10, 4, 41), "ApplicationMaster"),
    ("17/03/29 10:04:42 warn YarnAllocator: x", "WARN", "", 0, T(2017, 3, 29, 10, 4, 42), ""),
    ("2017-03-29 10:05:00,123 ERROR Foo: Info inside", "ERROR", "ERROR", 1,
     T(2017, 3, 29, 10, 5, 0, 123000), "Foo"),
    ("2017-03-29 10:05:00 DEBUG Foo: y", "DEBUG", "DEBUG", 1, T(2017, 3, 29, 10, 5, 0), "Foo"),
    ("17/03/29 10:04:43,500 INFO a.B: ok", "INFO", "INFO", 1, T(2017, 3, 29, 10, 4, 43, 500000), "a.B"),
    ("    at java.lang.Thread.run", "", "", 0, None, ""),
    ("warning only", "", "", 0, None, ""),
    ("LOG_ERROR token", "", "ERROR", 1, None, ""),
    ("see /error/ page", "ERROR", "", 0, None, ""),
    ("INFORMATION desk", "", "INFO", 1, None, ""),
    ("2017/03/29 10:06:00 Debug x", "DEBUG", "", 0, T(2017, 3, 29, 10, 6, 0), ""),
    ("17/13/29 10:04:41 INFO bad month", "INFO", "INFO", 1, None, ""),
    ("17/02/29 10:04:41 INFO not a leap year", "INFO", "INFO", 1, None, ""),
    ("99/01/01 00:00:00 INFO far year", "INFO", "INFO", 1, T(2099, 1, 1), ""),
    ("INFO then ERROR and WARN", "INFO", "INFO", 3, None, ""),
    ("", "", "", 0, None, ""),
    ("17/03/29 24:00:00 INFO hour 24", "INFO", "INFO", 1, None, ""),
    ("done at 2017-03-29 10:07:08 by job", "", "", 0, T(2017, 3, 29, 10, 7, 8), ""),
    ("17/06/10 15:11:55 INFO python.PythonRunner: Times: total = 39, boot = -157, init = 196, finish = 0",
     "INFO", "INFO", 1, T(2017, 6, 10, 15, 11, 55), "python.PythonRunner"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CORPUS)], "n int, line string")
    out = df.select("n", C.level("line", "word").alias("l1a"), C.level("line", "plain").alias("l1b"),
                    F.size(C.level_matches("line")).alias("occ"), C.log_time("line").alias("ts"),
                    C.component("line").alias("comp")).orderBy("n").collect()
    return out


@pytest.mark.parametrize("i", range(len(CORPUS)))
def test_edge_line(parsed, i):
    line, l1a, l1b, occ, ts, comp = CORPUS[i]
    r = parsed[i]
    assert (r["l1a"], r["l1b"], r["occ"], r["comp"]) == (l1a, l1b, occ, comp), line
    assert r["ts"] == ts, line


def test_null_line_gives_null(spark):
    r = spark.createDataFrame([(None,)], "line string").select(
        C.level("line").alias("l"), C.log_time("line").alias("t")).first()
    assert r["l"] is None and r["t"] is None


def test_anchored_time(spark):
    df = spark.createDataFrame([("17/03/29 10:04:41 INFO x",), ("x 17/03/29 10:04:41",)], "line string")
    got = [r[0] for r in df.select(C.log_time("line", "anchored")).collect()]
    assert got == [T(2017, 3, 29, 10, 4, 41), None]


def test_path_ids(spark):
    p = ".../application_1485248649253_0052/container_1485248649253_0052_01_000001.log"
    df = spark.createDataFrame([(p,), (".../other/x.log",)], "path string")
    rows = df.withColumns(C.path_ids("path")).withColumn("role", C.container_role("container_no")).collect()
    a, b = rows
    assert (a["cluster_id"], a["application_id"], a["app_number"]) == (
        "1485248649253", "application_1485248649253_0052", "0052")
    assert (a["container_id"], a["attempt"], a["container_no"], a["role"]) == (
        "container_1485248649253_0052_01_000001", "01", "000001", "ApplicationMaster")
    assert (b["application_id"], b["cluster_id"], b["container_id"], b["role"]) == ("", "", "", "")


def test_size_units(spark):
    df = spark.createDataFrame([("3.5", "GB"), ("10.5", "KB"), ("7", "B"), ("1", "TB")], "v string, u string")
    got = [r[0] for r in df.select(C.size_bytes(F.col("v"), F.col("u"))).collect()]
    assert got == [3.5 * 1024 ** 3, 10.5 * 1024, 7.0, float(1024 ** 4)]
