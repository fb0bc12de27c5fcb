"""Property tests: the Spark extractors against plain-Python definitions on random lines."""
import datetime as dt
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.operators import levels as LV

WORDS = ["INFO", "info", "WARN", "Warn", "ERROR", "error", "DEBUG", "x", "_", "LOG_ERROR", "INFORMATION",
         "WARNING", ":", "  ", "/", "17/03/29", "10:04:41", ",123", "2017-03-29", "a.B:", "-", "9"]
line_st = st.lists(st.sampled_from(WORDS), max_size=12).map(lambda ws: " ".join(ws))


def py_level_word(s):
    m = re.search(r"(?i)\b(INFO|WARN|ERROR|DEBUG)\b", s)
    return m.group(1).upper() if m else ""


def py_level_plain(s):
    m = re.search(r"(INFO|WARN|ERROR|DEBUG)", s)
    return m.group(1) if m else ""


@settings(max_examples=25, deadline=None)
@given(st.lists(line_st, min_size=1, max_size=40))
def test_levels_match_python(spark, lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, line string")
    got = df.select("n", C.level("line", "word").alias("w"), C.level("line", "plain").alias("p")) \
            .orderBy("n").collect()
    assert [(r["w"], r["p"]) for r in got] == [(py_level_word(x), py_level_plain(x)) for x in lines]
    occ = dict(LV.level_occurrences(df).collect())
    want = {}
    for x in lines:
        for m in re.findall(r"(INFO|WARN|ERROR|DEBUG)", x):
            want[m] = want.get(m, 0) + 1
    assert occ == want


def py_time(s):
    m = re.search(r"(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}(?:,\d{3})?|\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:,\d{3})?)", s)
    if not m:
        return None
    t = m.group(1)
    for fmt in ("%y/%m/%d %H:%M:%S,%f", "%y/%m/%d %H:%M:%S", "%Y-%m-%d %H:%M:%S,%f", "%Y-%m-%d %H:%M:%S"):
        try:
            v = dt.datetime.strptime(t, fmt)
        except ValueError:
            continue
        if fmt.startswith("%y") and v.year < 2000:
            v = v.replace(year=v.year + 100)          # two-digit years are 20yy
        return v
    return None


stamp = st.builds(lambda y, mo, d, h, mi, s, ms, iso: (
    f"{y:04d}-{mo:02d}-{d:02d} {h:02d}:{mi:02d}:{s:02d}" if iso else f"{y % 100:02d}/{mo:02d}/{d:02d} {h:02d}:{mi:02d}:{s:02d}")
    + (f",{ms:03d}" if ms is not None else ""),
    st.integers(2000, 2099), st.integers(1, 13), st.integers(1, 31), st.integers(0, 24), st.integers(0, 59),
    st.integers(0, 59), st.one_of(st.none(), st.integers(0, 999)), st.booleans())


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["", "x ", "INFO "]), stamp, st.sampled_from(["", " INFO a: b"])),
                min_size=1, max_size=30))
def test_time_matches_python(spark, parts):
    lines = [a + b + c for a, b, c in parts]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, line string")
    got = [r["t"] for r in C.with_log_time(df, "line", "t").orderBy("n").collect()]
    assert got == [py_time(x) for x in lines]
    assert got == [r[0] for r in df.orderBy("n").select(C.log_time("line")).collect()]


seg = st.sampled_from(["application_", "container_", "_", "01", "0052", "1485248649253", "000001", "x", "/",
                       "logs", ".log", "10001", "-"])
path_st = st.lists(seg, max_size=14).map("".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(path_st, min_size=1, max_size=30))
def test_path_ids_match_python(spark, paths):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "n int, path string")
    got = df.withColumns(C.path_ids("path")).orderBy("n").collect()

    def g(pat, s, i=1):
        m = re.search(pat, s)
        return m.group(i) if m else ""

    for r, p in zip(got, paths):
        app = g(r"(application_\d+_\d+)", p)
        cont = g(r"(container_\d+_\d+_\d+_\d+)", p)
        assert (r["application_id"], r["cluster_id"], r["app_number"]) == (
            app, g(r"application_(\d+)_\d+", app), g(r"application_\d+_(\d+)", app))
        assert (r["container_id"], r["attempt"], r["container_no"]) == (
            cont, g(r"container_\d+_\d+_(\d+)_(\d+)", cont, 1), g(r"container_\d+_\d+_(\d+)_(\d+)", cont, 2))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=60),
       st.integers(1, 12))
def test_histogram_invariants(spark, values, bins):
    from logscope.operators.timeline import histogram
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    h = histogram(df, "v", bins).collect()
    assert [r["bin"] for r in h] == list(range(bins))
    assert sum(r["count"] for r in h) == len(values) and {r["n"] for r in h} == {len(values)}
    lo, hi = min(values), max(values)
    want = [0] * bins
    for v in values:
        b = 0 if hi == lo else min(int(math.floor((v - lo) / ((hi - lo) / float(bins)))), bins - 1)
        want[b] += 1
    assert [r["count"] for r in h] == want
    assert want[0] >= 1 and want[-1] >= 1 or hi == lo
