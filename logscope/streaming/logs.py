"""Streaming forms of the log operators.

* ``read_logs_stream``: the text source as a stream ``(path, line)``; each
  micro-batch picks up files that appeared since the last one.
* ``level_totals_stream``: the one-row level aggregate (total, with level,
  per level); state is one row, so it runs in ``complete`` or ``update`` mode.
* ``app_bounds_stream``: first/last time per application, merged into
  per-application state (``update``).

State and progress live below the cluster's shared ``spark.checkpoint.dir``
(``<dir>/streams/<name>``) unless a location is given, so a restarted query
resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.operators.levels import level_totals
from logscope.session import checkpoint_dir


def read_logs_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None,
                     glob_filter: str | None = None, ignore_corrupt: bool = True) -> DataFrame:
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if ignore_corrupt:
        r = r.option("ignoreCorruptFiles", "true")
    if glob_filter:
        r = r.option("pathGlobFilter", glob_filter)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def level_totals_stream(logs: DataFrame, mode: str = "word") -> DataFrame:
    """Running ``total_lines, lines_with_level, n_INFO, ...``: the batch aggregate itself."""
    return level_totals(logs, mode)


def app_bounds_stream(logs: DataFrame) -> DataFrame:
    """Running ``(cluster_id, application_id, app_number, start_time, end_time)``.

    The state holds one row per application; lines never enter the state.
    """
    timed = C.with_log_time(logs, "line", "ts")
    t = (timed.filter(F.col("ts").isNotNull())
         .withColumn("application_id", C.application_id("path"))
         .filter(F.col("application_id") != ""))
    return (t.groupBy(C.cluster_id("application_id").alias("cluster_id"), "application_id",
                      C.app_number("application_id").alias("app_number"))
            .agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time")))


def start(df: DataFrame, name: str, sink: str = "memory", output_mode: str = "update",
          checkpoint_location: str | None = None, options: dict | None = None, trigger: dict | None = None):
    """Start ``df`` as a named streaming query with a durable checkpoint."""
    spark = df.sparkSession
    if checkpoint_location is None:
        base = checkpoint_dir(spark)
        if not base:
            raise RuntimeError("spark.checkpoint.dir is not set and no checkpoint_location was given")
        checkpoint_location = f"{base.rstrip('/')}/streams/{name}"
    w = (df.writeStream.format(sink).queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint_location))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
