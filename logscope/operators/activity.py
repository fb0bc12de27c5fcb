"""How work spreads over time (L6, L6d, L15): container concurrency, busy spells and idle gaps, memory state.

All three are sweeps over time-ordered rows of a key that may be hot (one cluster, one container), so they run
on the two-level scans of ``running``: no window holds more than one time range of one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.operators.events import GRAMMARS, parse_events
from logscope.operators.running import bucket_start, time_bucket, with_running
from logscope.operators.tasks import TASK_KEY, task_events
from logscope.session import materialize

HOUR = 3600
MICRO = 1_000_000.0


def _micros(a, b):
    """Exact microseconds from ``a`` to ``b``; sums of them are exact in any order."""
    return F.timestamp_diff("MICROSECOND", F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


# ------------------------------------------------------------------ concurrency of containers (L6d, L15)
def _sweep(containers: DataFrame, bucket_sec: int) -> DataFrame:
    """``(cluster_id, ts, started, ended, bucket, before)`` per instant at which containers of a cluster start or end;
    ``before`` counts those that are open just before it.  A container is open from its first to its last time, both included."""
    mark = lambda t, s, e: F.struct(F.col(t).alias("ts"), F.lit(s).cast("bigint").alias("started"), F.lit(e).cast("bigint").alias("ended"))
    marks = (containers.filter("start_time IS NOT NULL AND cluster_id != ''")
             .select("cluster_id", F.explode(F.array(mark("start_time", 1, 0), mark("end_time", 0, 1))).alias("m"))
             .groupBy("cluster_id", "m.ts").agg(F.sum("m.started").alias("started"), F.sum("m.ended").alias("ended")))
    marks = materialize(marks.withColumn("bucket", time_bucket("ts", bucket_sec)))
    swept = with_running(marks, ["cluster_id"], "bucket", ["ts"], {"before": (F.sum, F.col("started") - F.col("ended"), False)})
    return swept.withColumn("before", F.coalesce("before", F.lit(0)))


def container_intervals(files: DataFrame) -> DataFrame:
    """``(cluster_id, container_id, start_time, end_time)`` from the rows of ``timeline.container_timeline``."""
    return files.select(C.cluster_id("application_id").alias("cluster_id"), "container_id", "start_time", "end_time")


def concurrency_by_cluster(containers: DataFrame, bucket_sec: int = HOUR) -> DataFrame:
    """Per cluster: containers, first and last time, most containers open at once, when first, and their mean number
    over the cluster's span (container seconds / span seconds; 0 for an empty span)."""
    swept = _sweep(containers, bucket_sec).withColumn("open", F.col("before") + F.col("started"))
    peak = swept.groupBy("cluster_id").agg(
        F.sum("started").alias("num_containers"), F.min("ts").alias("first_time"), F.max("ts").alias("last_time"),
        F.max(F.struct("open", _micros("ts", bucket_start(F.lit(0), 1)).alias("earlier"), "ts")).alias("peak"))
    busy = (containers.filter("start_time IS NOT NULL").groupBy("cluster_id")
            .agg(F.sum(_micros("start_time", "end_time")).alias("us")))
    span = _micros("first_time", "last_time")
    return peak.join(busy, "cluster_id").select(
        "cluster_id", "num_containers", "first_time", "last_time", F.col("peak.open").alias("peak_containers"),
        F.col("peak.ts").alias("peak_time"), (F.col("us") / F.lit(MICRO)).alias("container_sec"),
        F.when(span > 0, F.col("us") / span).otherwise(F.lit(0.0)).alias("mean_containers"))


def concurrency_over_time(containers: DataFrame, bucket_sec: int = HOUR) -> DataFrame:
    """Per cluster and time range in which containers start or end: how many were open as it began, started and ended in it, the
    most open at once in it, and their mean number over it."""
    swept = _sweep(containers, bucket_sec)
    left = _micros("ts", bucket_start(F.col("bucket") + 1, bucket_sec))         # to the range's end
    per = swept.groupBy("cluster_id", "bucket").agg(
        F.min_by("before", "ts").alias("open_before"), F.sum("started").alias("started"), F.sum("ended").alias("ended"),
        F.max(F.col("before") + F.col("started")).alias("peak"),
        F.sum((F.col("started") - F.col("ended")) * left).alias("area"))
    return per.select("cluster_id", bucket_start("bucket", bucket_sec).alias("range_start"), "open_before", "started", "ended",
                      F.greatest("open_before", "peak").alias("peak_containers"),
                      ((F.col("open_before") * F.lit(int(bucket_sec * MICRO)) + F.col("area")) / F.lit(bucket_sec * MICRO)).alias("mean_containers"))


# ------------------------------------------------------------------ busy spells and idle gaps of containers (L6, L6d)
def task_intervals(logs: DataFrame) -> DataFrame:
    """``(application_id, container_id, start_time, end_time)`` per task with both times, in its container; an end
    before the start counts as the start."""
    t = (task_events(logs).filter("container_id != ''").groupBy("container_id", *TASK_KEY)
         .agg(F.min(F.when(F.col("event") == "Running", F.col("ts"))).alias("start_time"),
              F.max(F.when(F.col("event") == "Finished", F.col("ts"))).alias("end_time")))
    return (t.filter("start_time IS NOT NULL AND end_time IS NOT NULL")
            .select("application_id", "container_id", "start_time", F.greatest("start_time", "end_time").alias("end_time")))


def _spells(tasks: DataFrame, bucket_sec: int) -> DataFrame:
    """One row per distinct start in a container, with ``reach``: the last end of the tasks that started earlier.  Tasks overlap
    or touch as long as a start is not beyond ``reach``; a start beyond it opens a spell."""
    keys = ["application_id", "container_id"]
    starts = tasks.groupBy(*keys, "start_time").agg(F.max("end_time").alias("end_time"), F.count(F.lit(1)).alias("n"))
    starts = materialize(starts.withColumn("bucket", time_bucket("start_time", bucket_sec)))
    rows = with_running(starts, keys, "bucket", ["start_time"], {"reach": (F.max, F.col("end_time"), False)})
    return rows.withColumn("opens", (F.col("reach").isNull() | (F.col("start_time") > F.col("reach"))).cast("bigint"))


def container_activity(tasks: DataFrame, bucket_sec: int = HOUR) -> DataFrame:
    """Per container with timed tasks: its tasks, span from the first start to the last end, spells in which tasks overlap,
    busy and idle seconds, the longest gap and the idle share of the span (0 for an empty span)."""
    gap = F.when((F.col("opens") == 1) & F.col("reach").isNotNull(), _micros("reach", "start_time")).otherwise(F.lit(0))
    a = (_spells(tasks, bucket_sec).groupBy("application_id", "container_id")
         .agg(F.sum("n").alias("num_tasks"), F.min("start_time").alias("first_start"), F.max("end_time").alias("last_end"),
              F.sum("opens").alias("num_spells"), F.sum(gap).alias("idle"), F.max(gap).alias("longest")))
    span, sec = _micros("first_start", "last_end"), lambda c, name: (c / F.lit(MICRO)).alias(name)
    return a.select("application_id", "container_id", "num_tasks", "first_start", "last_end", "num_spells",
                    sec(span - F.col("idle"), "busy_sec"), sec(F.col("idle"), "idle_sec"), sec(F.col("longest"), "longest_gap_sec"),
                    F.when(span > 0, F.lit(100.0) * F.col("idle") / span).otherwise(F.lit(0.0)).alias("idle_pct"))


def busy_spells(tasks: DataFrame, bucket_sec: int = HOUR) -> DataFrame:
    """The spells themselves: per container their number in order, first start, last end, tasks and seconds."""
    keys = ["application_id", "container_id"]
    rows = materialize(_spells(tasks, bucket_sec))
    rows = with_running(rows, keys, "bucket", ["start_time"], {"spell": (F.sum, F.col("opens"), True)})
    s = rows.groupBy(*keys, "spell").agg(F.min("start_time").alias("spell_start"), F.max("end_time").alias("spell_end"),
                                         F.sum("n").alias("num_tasks"))
    return s.select(*keys, "spell", "spell_start", "spell_end", "num_tasks", C.seconds_between("spell_start", "spell_end").alias("spell_sec"))


# ------------------------------------------------------------------ memory state of containers
def memory_states(logs: DataFrame, bucket_sec: int = HOUR) -> DataFrame:
    """Every stored block with the capacity that its container last reported, and the share of it that is left free.

    An as-of join without a join: blocks and capacity lines are one frame, and the latest (time, capacity) so far is a running
    maximum.  Of capacities reported at one time the largest counts, and one at the block's own time counts already; a block
    without a time, or before the first report, has no capacity."""
    ev = logs if "kind" in logs.columns else parse_events(
        logs.filter(F.col("line").contains(GRAMMARS["stored_block"][0]) | F.col("line").contains(GRAMMARS["memory_capacity"][0])))
    ev = ev.filter(F.col("kind").isin("stored_block", "memory_capacity"))
    is_block, g = F.col("kind") == "stored_block", F.col("g")
    at = lambda i: F.get(g, i - 1)
    rows = ev.select(
        "application_id", "container_id", "ts", is_block.alias("is_block"),
        F.when(is_block, at(1)).alias("block_id"), F.when(is_block, at(2)).alias("stored_as"),
        F.when(is_block, C.size_bytes(at(3), at(4))).alias("size_bytes"), F.when(is_block, C.size_bytes(at(5), at(6))).alias("free_bytes"),
        F.when(~is_block, C.size_bytes(at(1), at(2))).alias("capacity"))
    rows = materialize(rows.withColumn("bucket", F.coalesce(time_bucket("ts", bucket_sec), F.lit(-1 << 62))))
    report = F.when(F.col("capacity").isNotNull() & F.col("ts").isNotNull(), F.struct("ts", "capacity"))
    # capacity lines come before the blocks of their time
    rows = with_running(rows, ["application_id", "container_id"], "bucket", ["ts", "is_block"], {"latest": (F.max, report, True)})
    cap = F.when(F.col("ts").isNotNull(), F.col("latest.capacity"))
    return rows.filter("is_block").select(
        "application_id", "container_id", "ts", "block_id", "stored_as", "size_bytes", "free_bytes", cap.alias("capacity_bytes"),
        F.when(cap > 0, F.col("free_bytes") / cap).alias("free_share"))


def memory_lows(states: DataFrame) -> DataFrame:
    """Per container: blocks stored, their bytes, blocks with a known capacity, lowest free bytes and lowest free share."""
    return (states.groupBy("application_id", "container_id")
            .agg(F.count(F.lit(1)).alias("num_blocks"), F.sum("size_bytes").alias("stored_bytes"),
                 F.count("capacity_bytes").alias("blocks_with_capacity"), F.min("free_bytes").alias("min_free_bytes"),
                 F.min("free_share").alias("min_free_share")))
