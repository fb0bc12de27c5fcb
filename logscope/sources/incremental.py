"""Incremental file bounds (S11): a manifest of the log files already read, so that a later run reads only new or changed ones.

The manifest is a parquet table with one row per file: its size and modification time as listed, its line count and the first
and last time in it.  A run compares the listing with the manifest (an anti-join on path, size and time), reads the files that are new,
grown or rewritten, and writes the next version: rows of unchanged files as they are, new rows for the others, none for files
that are gone.  Bounds of an application or cluster are minima and maxima over its files, so every timeline result follows from the
manifest, whatever was read when.

A version is a folder of its own and counts once its write is complete, so a run that fails leaves the last one in force.  A changed
file is read whole: its row is replaced, not added to.  Listing and reading take a part of the paths at a time
(``sources.logs.PATHS_AT_ONCE``), so the driver never holds the files of a large tree.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.operators.timeline import file_stats
from logscope.session import materialize, materialize_all
from logscope.sources.logs import PATHS_AT_ONCE, exact_path, list_logs, read_logs, small_files, tree_parts

MANIFEST_SCHEMA = ("path STRING, file_size BIGINT, modified TIMESTAMP, first_time TIMESTAMP_NTZ, last_time TIMESTAMP_NTZ, "
                   "num_lines BIGINT, file_bytes BIGINT")
_KEY = ["path", "file_size", "modified"]


@dataclass
class Update:
    """What a run did: the manifest's version and rows, files and bytes listed, files and bytes read."""

    version: int
    manifest: DataFrame
    files_listed: int
    bytes_listed: int
    files_read: int
    bytes_read: int


def _versions(spark: SparkSession, state: str) -> list[int]:
    """Complete versions below ``state``, ascending."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(state)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    numbers = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
    return [v for v in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{state}/v={v}/_SUCCESS"))]


def read_manifest(spark: SparkSession, state: str) -> DataFrame:
    """The last complete version; an empty frame before the first run."""
    have = _versions(spark, state.rstrip("/"))
    if not have:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{state.rstrip('/')}/v={have[-1]}")


def update_manifest(spark: SparkSession, root: str | list[str], state: str, *, recursive: bool = True, glob_filter: str | None = None,
                    time_mode: str = "lenient") -> Update:
    """Bring the manifest in ``state`` (a shared folder) up to date with the log files below ``root``."""
    state = state.rstrip("/")
    have = _versions(spark, state)
    old = read_manifest(spark, state)
    # a task for each core: more would store a table file of a few rows each, and a shuffle costs more than the scan
    cores = spark.sparkContext.defaultParallelism
    with small_files(spark):
        listing = materialize_all(spark, (list_logs(spark, part, recursive=recursive, glob_filter=glob_filter).select(*_KEY).coalesce(cores)
                                          for part in tree_parts(spark, root, recursive=recursive)))
    # the raw path is read, the plain one compares with the line reader's
    changed = materialize(listing.join(old, _KEY, "left_anti").withColumn("plain", C.plain_path("path")))
    n = changed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("b")).first()
    all_ = listing.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("b")).first()
    if not n["n"]:
        stats = None
    elif n["n"] == all_["n"] <= PATHS_AT_ONCE:
        stats = file_stats(read_logs(spark, root, recursive=recursive, glob_filter=glob_filter), time_mode)
    else:
        # by name, so that only changed files are read; a part of the names at a time, as the driver holds what a frame reads
        names = (exact_path(r["path"]) for r in changed.select("path").toLocalIterator())
        parts = iter(lambda: list(islice(names, PATHS_AT_ONCE)), [])
        with small_files(spark):
            stats = materialize_all(spark, (file_stats(read_logs(spark, part, recursive=False), time_mode) for part in parts))
    new = old.join(listing, _KEY, "left_semi")
    if stats is not None:
        rows = (changed.join(stats.select(C.plain_path("path").alias("plain"), "first_time", "last_time", "num_lines"), "plain", "left")
                .select(*_KEY, "first_time", "last_time", F.coalesce("num_lines", F.lit(0)).alias("num_lines"),
                        F.col("file_size").alias("file_bytes")))
        new = new.select(*[c.split()[0] for c in MANIFEST_SCHEMA.split(", ")]).unionByName(rows)
    version = (have[-1] if have else 0) + 1
    new.write.mode("overwrite").parquet(f"{state}/v={version}")
    return Update(version, read_manifest(spark, state), all_["n"], all_["b"], n["n"], n["b"])
