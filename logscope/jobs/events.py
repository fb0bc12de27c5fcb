"""Family D job: every documented message of the logs, parsed in one scan, and its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logscope.jobs.parallel import run_all
from logscope.operators import events as EV
from logscope.operators import tasks as TK
from logscope.session import materialize
from logscope.sinks import write_csv

BY_EVENT = {
    "executor_requests": EV.executor_requests, "container_requests": EV.container_requests,
    "request_shapes": EV.request_shapes, "input_splits": EV.input_splits,
    "python_worker_times": EV.python_worker_times, "memory_capacity": EV.memory_capacity,
    "stored_blocks": EV.stored_blocks, "broadcast_reads": EV.broadcast_reads, "cache_hits": EV.cache_hits,
    "cache_hits_by_rdd": EV.cache_hits_by_rdd, "shuffle_fetches": EV.shuffle_fetches,
    "unfinished_tasks": TK.unfinished_tasks, "container_failures": TK.container_failures,
}
BY_TASK = {
    "task_time_by_app": TK.task_time_by_app, "stage_skew": TK.stage_skew, "stage_bottlenecks": TK.stage_bottlenecks,
    "slowest_tasks": TK.slowest_tasks, "stages_per_app": TK.stages_per_app,
}


def run_events_job(spark: SparkSession, logs: DataFrame, outdir: str) -> dict[str, str]:
    """The lines are scanned once, into the event table (stored by kind); each output reads
    its kind only and is written as a folder of CSV files."""
    out = outdir.rstrip("/")
    events = EV.event_table(logs)
    tasks = materialize(TK.task_lifecycle(events), strict=True)
    frames = {k: fn(events) for k, fn in BY_EVENT.items()} | {k: fn(tasks) for k, fn in BY_TASK.items()}
    names = [*frames, "task_lifecycle"]
    frames["task_lifecycle"] = tasks
    written = run_all(*[lambda n=n: write_csv(frames[n], f"{out}/{n}", single_file=False) for n in names])
    return dict(zip(names, written))
