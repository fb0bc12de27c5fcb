"""Documented message grammars as event tables and per-application aggregates.

Each operator takes log lines or an event table (``event_table``: all messages of one
scan, stored by kind).  Lines are first tested for a literal hint (a cheap substring
test that prunes most lines before any regex runs, R14), then one evaluation of the
pattern gives all its groups, which are aggregated per application.  Every
aggregate is decomposable (count/sum/min/max/avg), so partial aggregation
runs per task and the shuffle carries one row per (task, key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.functions import patterns as P
from logscope.session import materialize, table_path


# kind -> (literal hint, pattern, number of groups)
GRAMMARS = {
    "executor_request": (P.EXECUTOR_REQUEST_HINT, P.EXECUTOR_REQUEST, 4),
    "container_request": (P.CONTAINER_REQUEST_HINT, P.CONTAINER_REQUEST, 3),
    "task": (P.TASK_EVENT_HINT, P.TASK_EVENT, 6),
    "input_split": (P.INPUT_SPLIT_HINT, P.INPUT_SPLIT, 3),
    "worker_times": (P.WORKER_TIMES_HINT, P.WORKER_TIMES, 4),
    "memory_capacity": (P.MEMORY_CAPACITY_HINT, P.MEMORY_CAPACITY, 2),
    "stored_block": (P.STORED_BLOCK_HINT, P.STORED_BLOCK, 6),
    "broadcast_read": (P.BROADCAST_READ_HINT, P.BROADCAST_READ, 1),
    "cache_hit": (P.CACHE_HIT_HINT, P.CACHE_HIT, 2),
    "shuffle_fetch": (P.SHUFFLE_FETCH_HINT, P.SHUFFLE_FETCH, 2),
}
ERROR = "error"         # any line whose level is ERROR
EVENTS_SCHEMA = "application_id string, container_id string, ts timestamp_ntz, g array<string>, kind string"


def parse_events(logs: DataFrame, time_mode: str = "lenient") -> DataFrame:
    """``(application_id, container_id, ts, g, kind)``: every documented message of every line,
    in ONE scan (R14): a literal hint first, then each pattern once per hinted line; ``g``
    holds the pattern's groups ('' for one that is absent).  A line that matches two grammars
    gives two rows.  Write it once partitioned by ``kind`` (``event_table``) and let all of
    L5-L14, L18 and the L6 family read their kind only."""
    line = F.col("line")
    upper = F.upper(line).contains("ERROR")
    hinted = upper
    for hint, _, _ in GRAMMARS.values():
        hinted = hinted | line.contains(hint)
    found = [F.when(line.contains(hint), F.struct(F.lit(kind).alias("kind"), C.marked_groups(line, pattern, n).alias("m")))
             for kind, (hint, pattern, n) in GRAMMARS.items()]
    is_error = F.when(upper, C.level("line", "word")) == "ERROR"
    found.append(F.when(is_error, F.struct(F.lit(ERROR).alias("kind"), F.lit("\u0001").alias("m"))))
    rows = C.with_log_time(logs.filter(hinted), "line", "ts", time_mode)
    rows = rows.select("path", "line", "ts", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("e"))
    g = F.split(F.substring(F.col("e.m"), 2, 1 << 30), "\u0001")
    return (rows.filter(F.col("e.m") != line)
            .select(C.application_id("path").alias("application_id"), C.container_id("path").alias("container_id"),
                    "ts", g.alias("g"), F.col("e.kind").alias("kind")))


def event_table(logs: DataFrame, path: str | None = None) -> DataFrame:
    """``parse_events`` written once, partitioned by kind, below ``path`` (default: a table of this
    application in the shared checkpoint folder), and read back; the log lines are scanned once."""
    spark = logs.sparkSession
    path = path or table_path(spark)
    # dealt by kind first, large kinds over several tasks, so that a scan task doesn't write a file of every kind
    parse_events(logs).hint("rebalance", "kind").write.partitionBy("kind").mode("overwrite").parquet(path)
    return spark.read.schema(EVENTS_SCHEMA).parquet(path)


def _events(logs: DataFrame, kind: str, groups: dict[str, tuple[int, str]], with_container: bool = False) -> DataFrame:
    """One kind's rows with typed groups, from log lines or from an event table."""
    cols = ["application_id", "container_id"] if with_container else ["application_id"]
    if "kind" in logs.columns:
        hits = logs.filter(F.col("kind") == kind)
    else:
        hint, pattern, n = GRAMMARS[kind]
        line = F.col("line")
        m = logs.filter(line.contains(hint)).withColumn("__m", C.marked_groups(line, pattern, n)).filter(F.col("__m") != line)
        hits = m.select(C.application_id("path").alias("application_id"), C.container_id("path").alias("container_id"),
                        F.split(F.substring("__m", 2, 1 << 30), "\u0001").alias("g"))
    return hits.select(*cols, *[v.alias(k) for k, v in C.typed_groups(F.col("g"), groups).items()])


# ------------------------------------------------------------------ resources
def executor_request_events(logs: DataFrame) -> DataFrame:
    return _events(logs, "executor_request", {
        "executors": (1, "bigint"), "cores": (2, "bigint"), "memory_mb": (3, "bigint"),
        "overhead_mb": (4, "bigint")})


def executor_requests(logs: DataFrame) -> DataFrame:
    """Per application: requests, executors asked in total and on average, mean cores,
    memory and overhead per executor (L5)."""
    return (executor_request_events(logs).groupBy("application_id")
            .agg(F.count(F.lit(1)).alias("num_requests"),
                 F.sum("executors").alias("total_executors"),
                 F.avg("executors").alias("avg_executors"),
                 F.avg("cores").alias("avg_cores"),
                 F.avg("memory_mb").alias("avg_memory_mb"),
                 F.avg("overhead_mb").alias("avg_overhead_mb")))


def container_requests(logs: DataFrame) -> DataFrame:
    """Container requests counted by (application, host, memory, vCores)."""
    ev = _events(logs, "container_request", {
        "host": (1, "string"), "memory_mb": (2, "bigint"), "vcores": (3, "bigint")})
    return (ev.groupBy("application_id", "host", "memory_mb", "vcores")
            .agg(F.count(F.lit(1)).alias("num_requests")))


def request_shapes(logs: DataFrame) -> DataFrame:
    """Most common requested (executors, cores, memory) shapes with their share.

    The per-shape aggregate is checkpointed (one row per distinct shape) and
    the grand total is a scalar subquery over it: no second scan of the logs
    and no single-partition window.
    """
    ev = executor_request_events(logs)
    shapes = materialize(ev.groupBy("executors", "cores", "memory_mb")
                         .agg(F.count(F.lit(1)).alias("num_requests"),
                              F.count_distinct("application_id").alias("num_applications")))
    total = shapes.select(F.sum("num_requests")).scalar()
    return (shapes.withColumn("share_pct", F.lit(100.0) * F.col("num_requests") / total)
            .orderBy(F.col("num_requests").desc(), "executors", "cores", "memory_mb"))


# ------------------------------------------------------------------ data and workers
def input_splits(logs: DataFrame) -> DataFrame:
    """Splits and bytes read per (application, input file)."""
    ev = _events(logs, "input_split", {
        "input_file": (1, "string"), "offset": (2, "bigint"), "length": (3, "bigint")})
    return (ev.groupBy("application_id", "input_file")
            .agg(F.count(F.lit(1)).alias("num_splits"), F.sum("length").alias("total_bytes"),
                 F.max(F.col("offset") + F.col("length")).alias("max_end_offset")))


def python_worker_times(logs: DataFrame) -> DataFrame:
    """Python worker time reports per application (L9); times may be negative.

    ``identity_mismatch`` counts reports where total != boot + init + finish.
    """
    ev = _events(logs, "worker_times", {
        "total_ms": (1, "bigint"), "boot_ms": (2, "bigint"), "init_ms": (3, "bigint"),
        "finish_ms": (4, "bigint")})
    return (ev.groupBy("application_id")
            .agg(F.count(F.lit(1)).alias("num_reports"),
                 F.avg("total_ms").alias("avg_total_ms"), F.avg("boot_ms").alias("avg_boot_ms"),
                 F.avg("init_ms").alias("avg_init_ms"), F.avg("finish_ms").alias("avg_finish_ms"),
                 F.percentile_approx("total_ms", 0.95, 10000).alias("p95_total_ms"),
                 F.max("total_ms").alias("max_total_ms"),
                 F.count_if(F.col("boot_ms") < 0).alias("negative_boot"),
                 F.count_if(F.col("total_ms") != F.col("boot_ms") + F.col("init_ms") + F.col("finish_ms"))
                 .alias("identity_mismatch")))


# ------------------------------------------------------------------ memory
def memory_capacity(logs: DataFrame) -> DataFrame:
    """Memory store capacity in bytes per container."""
    ev = _events(logs, "memory_capacity", {
        "value": (1, "string"), "unit": (2, "string")}, with_container=True)
    ev = ev.withColumn("capacity_bytes", C.size_bytes(F.col("value"), F.col("unit")))
    return (ev.groupBy("application_id", "container_id")
            .agg(F.max("capacity_bytes").alias("capacity_bytes"),
                 F.count(F.lit(1)).alias("num_starts")))


def stored_blocks(logs: DataFrame) -> DataFrame:
    """Blocks stored in memory by (application, block kind, storage form) (L11):
    count, total estimated size and the lowest free memory reported."""
    ev = _events(logs, "stored_block", {
        "block_id": (1, "string"), "stored_as": (2, "string"), "size_value": (3, "string"),
        "size_unit": (4, "string"), "free_value": (5, "string"), "free_unit": (6, "string")})
    ev = ev.select("application_id", F.substring_index("block_id", "_", 1).alias("block_kind"),
                   "stored_as", C.size_bytes(F.col("size_value"), F.col("size_unit")).alias("size_bytes"),
                   C.size_bytes(F.col("free_value"), F.col("free_unit")).alias("free_bytes"))
    return (ev.groupBy("application_id", "block_kind", "stored_as")
            .agg(F.count(F.lit(1)).alias("num_blocks"), F.sum("size_bytes").alias("total_size_bytes"),
                 F.min("free_bytes").alias("min_free_bytes")))


# ------------------------------------------------------------------ broadcast, cache, shuffle
def broadcast_reads(logs: DataFrame) -> DataFrame:
    """Broadcast variable reads and distinct variables per application."""
    ev = _events(logs, "broadcast_read", {"broadcast_id": (1, "bigint")})
    return (ev.groupBy("application_id")
            .agg(F.count(F.lit(1)).alias("num_reads"),
                 F.count_distinct("broadcast_id").alias("distinct_broadcasts")))


def cache_hits(logs: DataFrame) -> DataFrame:
    """Block lookups found in cache, by application and location."""
    ev = _events(logs, "cache_hit", {
        "block_id": (1, "string"), "location": (2, "string")})
    return (ev.groupBy("application_id", "location")
            .agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("block_id").alias("distinct_blocks")))


def cache_hits_by_rdd(logs: DataFrame) -> DataFrame:
    """Cached RDD blocks found, by application and RDD id (L13): hits, remote hits and distinct
    partitions of each RDD; block names other than ``rdd_<id>_<partition>`` are left out."""
    ev = _events(logs, "cache_hit", {"block_id": (1, "string"), "location": (2, "string")})
    ids = ev.select("application_id", "location", F.regexp_extract("block_id", P.RDD_BLOCK, 1).alias("r"),
                    F.regexp_extract("block_id", P.RDD_BLOCK, 2).try_cast("bigint").alias("part")).filter("r != ''")
    return (ids.groupBy("application_id", F.col("r").try_cast("bigint").alias("rdd_id"))
            .agg(F.count(F.lit(1)).alias("hits"), F.count_if(F.col("location") == "remotely").alias("remote_hits"),
                 F.count_distinct("part").alias("distinct_partitions")))


def shuffle_fetches(logs: DataFrame) -> DataFrame:
    """Remote shuffle fetches per application: reports, fetches, mean and max wait."""
    ev = _events(logs, "shuffle_fetch", {
        "fetches": (1, "bigint"), "fetch_ms": (2, "bigint")})
    return (ev.groupBy("application_id")
            .agg(F.count(F.lit(1)).alias("num_reports"), F.sum("fetches").alias("total_fetches"),
                 F.avg("fetch_ms").alias("avg_fetch_ms"), F.max("fetch_ms").alias("max_fetch_ms")))
