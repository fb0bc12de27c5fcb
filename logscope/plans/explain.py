"""Plan summaries: what a query's physical plan scans, shuffles and broadcasts."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import DataFrame


@contextmanager
def untruncated(spark):
    """Plans made inside show whole filter and column lists."""
    keys = {"spark.sql.maxMetadataStringLength": "100000", "spark.sql.debug.maxToStringFields": "10000"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def plan_summary(df: DataFrame) -> dict:
    """Counts of the operators that decide cost at scale, from the executed plan (made under
    ``untruncated`` the scans' filters and columns are complete)."""
    p = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan (\w+) \[", p)
    return {
        "scans": len(scans),
        "scan_formats": sorted(set(scans)),
        "read_schema": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", p))),
        "pushed_filters": sorted(set(f for f in re.findall(r"PushedFilters: \[([^\]]*)\]", p) if f)),
        "hash_exchanges": p.count("Exchange hashpartitioning"),
        "range_exchanges": p.count("Exchange rangepartitioning"),
        "single_partition_exchanges": p.count("Exchange SinglePartition"),
        "round_robin_exchanges": p.count("Exchange RoundRobinPartitioning"),
        "broadcasts": p.count("BroadcastExchange"),
        "windows": len(re.findall(r"(?m)^\W*Window \[", p)),
        "subqueries": len(re.findall(r"Subquery (?:scalar-)?subquery#\d+", p)),
        "python_udfs": p.count("BatchEvalPython") + p.count("ArrowEvalPython"),
        "cartesian": p.count("CartesianProduct") + p.count("NestedLoopJoin"),
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", p))),
    }
