"""Family A: counts, summary invariants, zero-fill, sampling."""
from pyspark.sql import functions as F

from logscope.operators import levels as LV
from logscope.sources import log_lines

from conftest import SF_MID


def test_level_counts_fixture(fixture_lines):
    got = [tuple(r) for r in LV.level_counts(fixture_lines).collect()]
    assert got == [("INFO", 749), ("WARN", 187), ("ERROR", 201), ("DEBUG", 63)]


def test_summary_invariants(spark):
    s = LV.level_summary(log_lines(spark, SF_MID)).collect()
    assert [r["log_level"] for r in s] == ["INFO", "WARN", "ERROR", "DEBUG"]
    assert sum(r["count"] for r in s) == s[0]["lines_with_level"] == 12029
    assert s[0]["total_lines"] == 12598 >= s[0]["lines_with_level"]
    assert abs(sum(r["share_pct"] for r in s) - 100.0) < 1e-9
    assert s[0]["unique_levels"] == 4


def test_empty_input_zero_fill(spark):
    empty = spark.createDataFrame([], "path string, line string")
    s = LV.level_summary(empty).collect()
    assert [(r["log_level"], r["count"], r["share_pct"]) for r in s] == [
        ("INFO", 0, 0.0), ("WARN", 0, 0.0), ("ERROR", 0, 0.0), ("DEBUG", 0, 0.0)]
    assert s[0]["unique_levels"] == 0


def test_plain_mode_is_case_sensitive(spark):
    c = LV.level_counts(log_lines(spark, SF_MID), mode="plain").collect()
    assert sum(r["count"] for r in c) == 10029


def test_occurrences(spark):
    df = spark.createDataFrame([("INFO then ERROR and WARN",), ("LOG_ERROR x",), ("none",)], "line string")
    assert dict(LV.level_occurrences(df).collect()) == {"INFO": 1, "ERROR": 2, "WARN": 1}


def test_sample_members_and_size(fixture_lines):
    s = LV.sample_lines(fixture_lines, n=10).collect()
    assert len(s) == 10
    lines = {r["line"] for r in fixture_lines.collect()}
    assert all(r["log_entry"] in lines and r["log_level"] in ("INFO", "WARN", "ERROR", "DEBUG") for r in s)


def test_sample_seeded_is_reproducible(fixture_lines):
    a = LV.sample_lines(fixture_lines, n=10, seed=7, key="line_no").collect()
    b = LV.sample_lines(fixture_lines, n=10, seed=7, key="line_no").collect()
    assert a == b


def test_sample_smaller_than_n(spark):
    df = spark.createDataFrame([("INFO a",), ("b",)], "line string")
    assert [r["log_entry"] for r in LV.sample_lines(df, n=10).collect()] == ["INFO a"]


def test_lines_containing(fixture_lines):
    n = LV.lines_containing(fixture_lines, "ERROR").count()
    assert n == fixture_lines.filter(F.col("line").contains("ERROR")).count() > 0


def test_materialized_corpus_equals_lazy(spark):
    from logscope.sources.fixture import log_lines as ll
    a = ll(spark, SF_MID, materialized=True)
    b = ll(spark, SF_MID, materialized=False)
    assert a.count() == b.count() == 12598
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert "FileScan parquet" in a._jdf.queryExecution().executedPlan().toString()


def test_materialize_without_checkpoint_folder_stays_lazy(spark):
    import pytest

    from logscope.session import materialize

    class _NoConf:
        def get(self, *_):
            return None

    class _Ctx:
        def getConf(self):
            return _NoConf()

    class _Session:          # a session whose cluster names no checkpoint folder
        conf = _NoConf()
        sparkContext = _Ctx()

    df = spark.range(3)
    assert materialize(df, _Session()) is df
    with pytest.raises(RuntimeError):
        materialize(df, _Session(), strict=True)


def test_reports_on_empty_input(spark):
    from logscope.operators import reports as RP
    from logscope.operators import timeline as TL
    empty = spark.createDataFrame([], "path string, line string")
    lines = [r["text"] for r in RP.level_report(LV.level_summary(empty)).orderBy("line_no").collect()]
    assert lines[:3] == ["Total log lines processed: 0", "Total lines with log levels: 0",
                         "Unique log levels found: 0"]
    assert lines[5] == "  INFO :          0 (  0.00%)" and len(lines) == 9
    s = TL.cluster_summary(TL.app_timeline(empty, ordered=False), ordered=False)
    u = [r["text"] for r in RP.usage_report(TL.usage_stats(s), TL.top_clusters(s, 5)).orderBy("line_no").collect()]
    assert u == ["Total unique clusters: 0", "Total applications: 0", "Average applications per cluster: 0.00",
                 "", "Most heavily used clusters:"]


def test_materialize_writes_a_table_and_clear_removes_it(spark):
    import os

    from logscope.session import checkpoint_dir, clear_materialized, materialize
    m = materialize(spark.range(5).selectExpr("id * 2 AS x"))
    assert sorted(r["x"] for r in m.collect()) == [0, 2, 4, 6, 8]
    assert "FileScan parquet" in m._jdf.queryExecution().executedPlan().toString()
    base = checkpoint_dir(spark)
    if base.startswith("/") or base.startswith("file:"):
        folder = os.path.join(base.replace("file:", ""), "logscope-tables", spark.sparkContext.applicationId)
        assert os.path.isdir(folder)
        clear_materialized(spark)
        assert not os.path.exists(folder)


def test_one_pass_sample_is_uniform_and_complete(spark):
    """Every line is as likely as any other; each draw holds distinct lines with their levels."""
    rows = [(f"{i} {'ERROR' if i % 3 else 'info'} x",) for i in range(60)] + [("no level",)] * 5
    df = spark.createDataFrame(rows, "line string").coalesce(1)
    seen = {}
    for seed in range(40):
        t = LV.totals_with_sample(df, n=4, seed=seed)
        got = LV.sample_of(t).collect()
        assert len(got) == len({r["log_entry"] for r in got}) <= 4
        for r in got:
            assert r["log_level"] in r["log_entry"].upper()
            seen[r["log_entry"]] = seen.get(r["log_entry"], 0) + 1
    assert "no level" not in seen and max(seen.values()) <= 12 and len(seen) > 45
    row = t.first()
    assert (row["total_lines"], row["lines_with_level"], row["n_ERROR"]) == (65, 60, 40) and sorted(row["levels"]) == ["ERROR", "INFO"]


def test_one_pass_on_few_and_no_lines(spark):
    none = spark.createDataFrame([], "line string")
    assert LV.sample_of(LV.totals_with_sample(none, 3)).collect() == []
    assert [r["count"] for r in LV.summary_of(LV.totals_with_sample(none, 3)).collect()] == [0] * 4
    one = spark.createDataFrame([("INFO only",)], "line string")
    assert [tuple(r) for r in LV.sample_of(LV.totals_with_sample(one, 3)).collect()] == [("INFO only", "INFO")]
