"""Stage precedence and critical path.

A stage lasts from the first start to the last end of its tasks.  Stage A precedes B if A has ended when B starts: an
interval order.  Starts and ends are ranked in one sequence per application, so that a stage is a pair of
whole numbers and precedence a comparison; where times are equal, ends of stages come before stages without duration (by
number), and these before starts, so the order has no cycle.

*Transitive reduction* without meeting all pairs: B follows A directly if it starts after A ends and before any stage that itself
started after A has ended; that bound is a running minimum over the sequence read backwards (``running``), and the edges are a range join
that emits no other pair.

*Critical path*: the chain of stages with the largest total duration.  Totals are relaxed along the stored edges round by
round until none grows, as many rounds as the longest chain has stages; each round is a join and a grouped maximum, its result written
before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.operators.activity import HOUR, MICRO, _micros
from logscope.operators.running import time_bucket, with_running
from logscope.session import materialize

BLOCK = 4096        # ranks that a window reads together
WIDTH = 16          # ranks in which a range and the starts inside it meet


def stage_spans(tasks: DataFrame) -> DataFrame:
    """``(application_id, stage_id, start_time, end_time, us, s, e)`` per stage with timed tasks (``tasks.task_lifecycle``): ``us`` its microseconds,
    ``s`` < ``e`` the ranks of its start and end in the application's sequence, all distinct."""
    keys = ["application_id", "stage_id"]
    spans = (tasks.filter("stage_id IS NOT NULL AND start_time IS NOT NULL AND end_time IS NOT NULL").groupBy(*keys)
             .agg(F.min("start_time").alias("start_time"), F.max(F.greatest("start_time", "end_time")).alias("end_time")))
    empty = F.col("start_time") == F.col("end_time")
    # at one time: ends, then stages without duration (each its start, then its end), then starts
    mark = lambda t, end: F.struct(F.col(t).alias("ts"), F.when(empty, 1).otherwise(0 if end else 2).alias("class"),
                                   F.when(empty, F.col("stage_id")).otherwise(F.lit(0)).alias("own"), F.lit(end).alias("is_end"))
    marks = spans.select(*keys, F.explode(F.array(mark("start_time", False), mark("end_time", True))).alias("m")).select(*keys, "m.*")
    marks = materialize(marks.withColumn("bucket", time_bucket("ts", HOUR)))
    order = ["ts", "class", "own", "is_end", "stage_id"]
    ranked = with_running(marks, ["application_id"], "bucket", order, {"rank": (F.sum, F.lit(1).cast("bigint"), True)})
    ranks = ranked.groupBy(*keys).agg(F.max(F.when(~F.col("is_end"), F.col("rank"))).alias("s"), F.max(F.when(F.col("is_end"), F.col("rank"))).alias("e"))
    return spans.join(ranks, keys).withColumn("us", _micros("start_time", "end_time"))


def stage_precedence(spans: DataFrame) -> DataFrame:
    """Edges of the reduced order of ``spans`` (a stored ``stage_spans``): ``(application_id, from_stage, to_stage, wait_sec)``,
    ``wait_sec`` from the end of the one to the start of the other."""
    app = ["application_id"]
    side = lambda rank, is_end: F.struct(F.col(rank).alias("rank"), F.lit(is_end).alias("is_end"))
    marks = spans.select(*app, "stage_id", "e", F.explode(F.array(side("s", False), side("e", True))).alias("m"))
    marks = marks.select(*app, "stage_id", "e", "m.rank", "m.is_end", (-F.col("m.rank")).alias("back"))
    marks = materialize(marks.withColumn("bucket", F.floor(F.col("back") / F.lit(BLOCK))))
    # read backwards: the least end among the stages that start later
    bound = with_running(marks, app, "bucket", ["back"], {"until": (F.min, F.when(~F.col("is_end"), F.col("e")), False)})
    bound = bound.filter("is_end AND until IS NOT NULL").select(*app, F.col("stage_id").alias("from_stage"), "rank", "until")
    ends = spans.select(*app, F.col("stage_id").alias("from_stage"), F.col("end_time").alias("__end"))
    nexts = spans.select(*app, F.col("stage_id").alias("to_stage"), F.col("s"), F.col("start_time").alias("__start"),
                         F.floor(F.col("s") / F.lit(WIDTH)).alias("at"))
    # every start in the range is an edge; ranges and starts meet in short stretches of ranks
    ranges = bound.withColumn("at", F.explode(F.sequence(F.floor(F.col("rank") / F.lit(WIDTH)), F.floor(F.col("until") / F.lit(WIDTH)))))
    direct = ranges.join(nexts, [*app, "at"]).filter((F.col("s") > F.col("rank")) & (F.col("s") < F.col("until")))
    return (direct.join(ends, [*app, "from_stage"])
            .select(*app, "from_stage", "to_stage", (_micros("__end", "__start") / F.lit(MICRO)).alias("wait_sec")))


def critical_paths(spans: DataFrame, edges: DataFrame) -> DataFrame:
    """Per application: stages, seconds on its critical path, the path's stages in order, the application's span, and the path's share
    of it.  Of equally long chains the one with more stages counts, then the one that reads smaller from its end."""
    app = ["application_id"]
    edges = materialize(edges.select(*app, "from_stage", "to_stage"))
    total = materialize(spans.select(*app, "stage_id", "us", F.col("us").alias("total"), F.lit(1).alias("hops"), F.array("stage_id").alias("path")))
    while True:
        # best predecessor: longest, most stages, smallest from its end (the negated reverse is the largest)
        back = F.transform(F.reverse("path"), lambda x: -x)
        via = (edges.join(total.withColumnRenamed("stage_id", "from_stage"), [*app, "from_stage"])
               .groupBy(*app, F.col("to_stage").alias("stage_id"))
               .agg(F.max(F.struct("total", "hops", back.alias("back"), "path")).alias("p")))
        grown = total.join(via, [*app, "stage_id"], "left").withColumn("was", F.struct("total", "hops", "path"))
        has = F.col("p").isNotNull()
        grown = grown.select(*app, "stage_id", "us", F.when(has, F.col("us") + F.col("p.total")).otherwise(F.col("us")).alias("total"),
                             F.when(has, F.col("p.hops") + 1).otherwise(F.lit(1)).alias("hops"),
                             F.when(has, F.concat("p.path", F.array("stage_id"))).otherwise(F.array("stage_id")).alias("path"), "was")
        grown = materialize(grown.withColumn("new", F.struct("total", "hops", "path") != F.col("was")).drop("was"))
        total = grown.drop("new")
        if grown.filter("new").isEmpty():
            break
    best = total.groupBy(*app).agg(
        F.max(F.struct("total", "hops", F.transform(F.reverse("path"), lambda x: -x).alias("back"), "path")).alias("p"))
    ranges = spans.groupBy(*app).agg(F.count(F.lit(1)).alias("num_stages"), F.min("start_time").alias("a"), F.max("end_time").alias("b"))
    span = _micros("a", "b")
    return ranges.join(best, app).select(
        *app, "num_stages", F.col("p.hops").cast("bigint").alias("path_stages"), (F.col("p.total") / F.lit(MICRO)).alias("path_sec"),
        F.array_join(F.col("p.path").cast("array<string>"), ">").alias("path"), (span / F.lit(MICRO)).alias("span_sec"),
        F.when(span > 0, F.lit(100.0) * F.col("p.total") / span).otherwise(F.lit(0.0)).alias("path_pct"))
