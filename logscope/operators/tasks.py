"""Task lifecycle and the analyses built on it.

Pairing a ``Running task`` line with its ``Finished task`` line (J3) needs no join:
both carry the same (application, stage, attempt, task, TID) key, so one
conditional aggregate over that key gives start and end.  TIDs are unique
within an application only, so the application is always part of the key.
Keys have at most two lines each, so no key can be hot; the later per-stage
and per-application frames are small aggregates of the task table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.functions import patterns as P
from logscope.operators.events import ERROR, parse_events

TASK_KEY = ["application_id", "stage_id", "stage_attempt", "task_index", "task_attempt", "tid"]


_GROUPS = {"event": (1, "string"), "task_index": (2, "bigint"), "task_attempt": (3, "bigint"),
           "stage_id": (4, "bigint"), "stage_attempt": (5, "bigint"), "tid": (6, "bigint")}


def task_events(logs: DataFrame, time_mode: str = "lenient") -> DataFrame:
    """``Running`` / ``Finished`` lines with their time and task key, from log lines or an event table."""
    ev = logs if "kind" in logs.columns else parse_events(
        logs.filter(F.col("line").contains(P.TASK_EVENT_HINT)), time_mode)
    return (ev.filter(F.col("kind") == "task")
            .select("application_id", "container_id", "ts",
                    *[v.alias(k) for k, v in C.typed_groups(F.col("g"), _GROUPS).items()]))


def task_lifecycle(logs: DataFrame) -> DataFrame:
    """One row per task: start (Running), end (Finished), duration in seconds, and whether a
    ``Finished`` line was seen (L6); a finished task without a valid time has a NULL duration."""
    ev = task_events(logs)
    t = (ev.groupBy(*TASK_KEY)
         .agg(F.min(F.when(F.col("event") == "Running", F.col("ts"))).alias("start_time"),
              F.max(F.when(F.col("event") == "Finished", F.col("ts"))).alias("end_time"),
              (F.count_if(F.col("event") == "Finished") > 0).alias("finished")))
    return t.select(*TASK_KEY, "start_time", "end_time",
                    C.seconds_between("start_time", "end_time").alias("duration_sec"), "finished")


def task_time_by_app(tasks: DataFrame) -> DataFrame:
    """Per application: tasks, finished tasks, mean / max / total task seconds."""
    return (tasks.groupBy("application_id")
            .agg(F.count(F.lit(1)).alias("num_tasks"), F.count_if("finished").alias("finished_tasks"),
                 F.avg("duration_sec").alias("avg_task_sec"), F.max("duration_sec").alias("max_task_sec"),
                 F.sum("duration_sec").alias("total_task_sec")))


def _failures(logs: DataFrame, by: list[str]) -> DataFrame:
    """Per ``by``: tasks, tasks without a Finished line, retried tasks, ERROR lines.

    One scan and one shuffle: task lines are keyed by their task, ERROR lines by
    a NULL task, so a single aggregate yields both; partial aggregation turns the
    error lines of a key into one row per task before the shuffle.
    """
    ev = logs if "kind" in logs.columns else parse_events(logs)
    g = C.typed_groups(F.col("g"), _GROUPS)
    is_task = F.col("kind") == "task"
    rows = (ev.filter(F.col("kind").isin("task", ERROR))
            .select(*by, is_task.alias("is_task"), *[F.when(is_task, v).alias(k) for k, v in g.items()]))
    key = [k for k in TASK_KEY if k not in by]
    per_key = rows.groupBy(*by, *key).agg(
        (F.count_if(F.col("event") == "Finished") > 0).alias("finished"),
        F.count_if("is_task").alias("task_lines"), F.count_if(~F.col("is_task")).alias("error_lines"))
    task = F.col("task_lines") > 0
    return per_key.groupBy(*by).agg(
        F.count_if(task).alias("num_tasks"), F.count_if(task & ~F.col("finished")).alias("unfinished_tasks"),
        F.count_if(task & (F.col("task_attempt") > 0)).alias("retried_tasks"),
        F.sum("error_lines").cast("bigint").alias("error_lines"))


def unfinished_tasks(logs: DataFrame) -> DataFrame:
    """Per application with tasks: tasks never reported finished, their share, retried tasks
    (attempt > 0) and ERROR lines of the application (L6c)."""
    a = _failures(logs, ["application_id"]).filter("num_tasks > 0")
    return a.select("application_id", "num_tasks", "unfinished_tasks",
                    (F.lit(100.0) * F.col("unfinished_tasks") / F.col("num_tasks")).alias("unfinished_pct"),
                    "retried_tasks", "error_lines")


def container_failures(logs: DataFrame) -> DataFrame:
    """Per container with a task or an ERROR line: tasks, unfinished and retried tasks, ERROR lines."""
    return _failures(logs, ["application_id", "container_id"]).filter("container_id != ''")


def stage_skew(tasks: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Per (application, stage): finished tasks and the spread of their durations.

    ``max_over_median`` and ``p95_over_median`` flag skewed stages; NULL when
    the median is 0.
    """
    d = tasks.filter(F.col("duration_sec").isNotNull())
    s = (d.groupBy("application_id", "stage_id")
         .agg(F.count(F.lit(1)).alias("num_tasks"),
              F.percentile_approx("duration_sec", 0.5, accuracy).alias("median_sec"),
              F.percentile_approx("duration_sec", 0.95, accuracy).alias("p95_sec"),
              F.max("duration_sec").alias("max_sec")))
    ratio = lambda a: F.when(F.col("median_sec") > 0, F.col(a) / F.col("median_sec"))
    return s.select("application_id", "stage_id", "num_tasks", "median_sec", "p95_sec", "max_sec",
                    ratio("max_sec").alias("max_over_median"), ratio("p95_sec").alias("p95_over_median"))


def stage_bottlenecks(tasks: DataFrame) -> DataFrame:
    """Per (application, stage): total task time, its share of the application's
    task time, the slowest task, and the stage's rank in its application (L7b).

    The window runs over the per-stage aggregate (stages per application),
    never over task or line rows.
    """
    s = (tasks.groupBy("application_id", "stage_id")
         .agg(F.count(F.lit(1)).alias("num_tasks"),
              F.coalesce(F.sum("duration_sec"), F.lit(0.0)).alias("total_task_sec"),
              F.max("duration_sec").alias("max_task_sec")))
    w = Window.partitionBy("application_id")
    app_total = F.sum("total_task_sec").over(w)
    rank = F.rank().over(w.orderBy(F.col("total_task_sec").desc(), F.col("stage_id")))
    return s.select("application_id", "stage_id", "num_tasks", "total_task_sec", "max_task_sec",
                    F.when(app_total > 0, F.lit(100.0) * F.col("total_task_sec") / app_total)
                    .otherwise(F.lit(0.0)).alias("share_pct"),
                    rank.alias("stage_rank"))


def slowest_tasks(tasks: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` tasks that took longest (L7b); ties by their key.  TakeOrderedAndProject:
    each task of the job keeps its own top ``n``, the input is never sorted as a whole."""
    return (tasks.filter(F.col("duration_sec").isNotNull())
            .orderBy(F.col("duration_sec").desc(), *TASK_KEY).limit(n)
            .select(*TASK_KEY, "start_time", "end_time", "duration_sec"))


def stages_per_app(tasks: DataFrame) -> DataFrame:
    """Per application: distinct stages, tasks and mean tasks per stage."""
    return (tasks.groupBy("application_id")
            .agg(F.count_distinct("stage_id").alias("num_stages"), F.count(F.lit(1)).alias("num_tasks"))
            .withColumn("avg_tasks_per_stage",
                        F.when(F.col("num_stages") > 0, F.col("num_tasks") / F.col("num_stages"))))
