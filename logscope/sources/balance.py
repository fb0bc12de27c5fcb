"""Input balancing for inputs that arrive in fewer splits than the cluster has cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` (H3) over at least ``min_partitions`` tasks when its scan
    yields fewer (a single-row-group parquet file is one task however large).

    The check is made at planning time (no job runs).  On a large input the
    scan already has thousands of splits and ``df`` is returned unchanged, so
    no shuffle is ever added at scale; on a small one the shuffle moves a few
    MB and lets the per-line work use every core.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:       # sessions without RDD access (Spark Connect): leave the plan as it is
        return df
    if splits >= target:
        return df
    return df.repartition(target)
