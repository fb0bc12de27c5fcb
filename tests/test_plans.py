"""Plan shape: one scan per level job, pushed range filter, pruned columns, no Python in plans."""
from logscope.operators import daily as DY
from logscope.operators import levels as LV
from logscope.operators import timeline as TL
from logscope.plans.catalog import QUERIES
from logscope.sources import read_logs, read_table

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_level_summary_single_scan(spark, log_tree):
    p = plan(LV.level_summary(read_logs(spark, log_tree)))
    assert p.count("FileScan") == 1 and "SortMergeJoin" not in p and "BroadcastHashJoin" not in p


def test_timeline_single_scan_per_file_aggregate(spark, log_tree):
    p = plan(TL.app_timeline(read_logs(spark, log_tree)))
    assert p.count("FileScan") == 1


def test_daily_pushdown_and_pruning(spark):
    spec = DY.DailySpec(ts="l_shipdate", mean=("l_quantity", "m"))
    p = plan(DY.daily_summary(read_table(spark, SF_SMALL, "lineitem"), spec, 1996))
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_no_python_evaluation_in_any_query(spark):
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_single_partition_exchanges_only_after_partial_aggregates(spark):
    """A global aggregate may gather to one task only rows already reduced per task."""
    for name, fn in QUERIES.items():
        lines = plan(fn(spark, SF_SMALL)).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                child = lines[i + 1]
                assert "HashAggregate" in child and "partial_" in child, (name, child)
