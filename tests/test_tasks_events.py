"""Task lifecycle and event extractors on the fixture and on hand-written lines."""
from logscope.operators import events as EV
from logscope.operators import records as RC
from logscope.operators import tasks as TK


def test_task_counts(fixture_lines):
    t = TK.task_lifecycle(fixture_lines)
    assert t.count() == 288
    assert t.filter("NOT finished").count() == 26


def _logs(spark, lines, path="/l/application_1_0001/container_1_0001_01_000002.log"):
    return spark.createDataFrame([(path, i, x) for i, x in enumerate(lines)], "path string, line_no long, line string")


def test_task_pairing_and_skew(spark):
    logs = _logs(spark, [
        "17/01/01 00:00:00 INFO executor.Executor: Running task 0.0 in stage 1.0 (TID 1)",
        "17/01/01 00:00:10 INFO executor.Executor: Finished task 0.0 in stage 1.0 (TID 1)",
        "17/01/01 00:00:00 INFO executor.Executor: Running task 1.1 in stage 1.0 (TID 2)",
        "17/01/01 00:00:02 INFO executor.Executor: Finished task 1.1 in stage 1.0 (TID 2)",
        "17/01/01 00:00:00 INFO executor.Executor: Running task 2.0 in stage 1.0 (TID 3)"])
    t = TK.task_lifecycle(logs)
    d = {r["tid"]: r["duration_sec"] for r in t.collect()}
    assert d == {1: 10.0, 2: 2.0, 3: None}
    u = TK.unfinished_tasks(logs).first()
    assert (u["num_tasks"], u["unfinished_tasks"], u["retried_tasks"], u["error_lines"]) == (3, 1, 1, 0)
    sk = TK.stage_skew(t).first()
    assert (sk["num_tasks"], sk["median_sec"], sk["max_sec"], sk["max_over_median"]) == (2, 2.0, 10.0, 5.0)
    b = TK.stage_bottlenecks(t).first()
    assert (b["total_task_sec"], b["share_pct"], b["stage_rank"]) == (12.0, 100.0, 1)


def test_event_extractors(spark):
    logs = _logs(spark, [
        "17/03/29 10:04:43 INFO YarnAllocator: Will request 16 executor containers, each with 5 cores "
        "and 28160 MB memory including 2560 MB overhead",
        "17/03/29 10:04:44 INFO YarnAllocator: Will request 2 executor containers, each with 1 cores and 1024 MB memory",
        "17/06/10 15:11:55 INFO python.PythonRunner: Times: total = 39, boot = -157, init = 196, finish = 0",
        "17/06/08 12:12:42 INFO storage.MemoryStore: Block broadcast_278 stored as values in memory "
        "(estimated size 10.5 KB, free 2.5 MB)",
        "17/02/01 21:13:56 INFO storage.ShuffleBlockFetcherIterator: Started 2 remote fetches in 0 ms",
        "17/06/08 21:22:22 INFO storage.BlockManager: Found block rdd_24492_27 locally",
        "17/03/29 10:11:10 INFO rdd.HadoopRDD: Input split: hdfs://10.10.34.11:9000/pjhe/input/a.txt:11902664+1487833",
        "17/03/29 10:11:10 INFO storage.MemoryStore: MemoryStore started with capacity 2.5 GB",
        "17/03/29 10:11:10 INFO executor: host mesos-slave-7 and mesos-slave-7 and mesos-master-1"])
    e = EV.executor_requests(logs).first()
    assert (e["num_requests"], e["total_executors"], e["avg_cores"], e["avg_overhead_mb"]) == (2, 18, 3.0, 2560.0)
    w = EV.python_worker_times(logs).first()
    assert (w["negative_boot"], w["identity_mismatch"], w["avg_total_ms"]) == (1, 0, 39.0)
    b = EV.stored_blocks(logs).first()
    assert (b["block_kind"], b["stored_as"], b["total_size_bytes"], b["min_free_bytes"]) == (
        "broadcast", "values", 10752.0, 2.5 * 1024 ** 2)
    assert EV.shuffle_fetches(logs).first()["total_fetches"] == 2
    assert EV.cache_hits(logs).first()["location"] == "locally"
    s = EV.input_splits(logs).first()
    assert (s["input_file"], s["total_bytes"]) == ("hdfs://10.10.34.11:9000/pjhe/input/a.txt", 1487833)
    assert EV.memory_capacity(logs).first()["capacity_bytes"] == 2.5 * 1024 ** 3
    hosts = {r["host"]: (r["lines"], r["containers"]) for r in RC.host_activity(logs).collect()}
    assert hosts == {"mesos-slave-7": (1, 1), "mesos-master-1": (1, 1), "10.10.34.11": (1, 1)}


def _entries(df):
    return sorted((r["entry_line_no"], r["num_lines"], r["has_header"], r["entry_text"]) for r in df.collect())


def test_stitched_entries_multiline(spark):
    logs = _logs(spark, ["   orphan", "   orphan 2", "17/03/29 10:04:41 INFO A: x", "   k -> v", "   k2",
                         "17/03/29 10:04:42 INFO B: y"])
    assert _entries(RC.stitched_entries(logs)) == [
        (0, 1, False, "   orphan"), (1, 1, False, "   orphan 2"),
        (2, 3, True, "17/03/29 10:04:41 INFO A: x\n   k -> v\n   k2"),
        (5, 1, True, "17/03/29 10:04:42 INFO B: y")]


def test_stitched_entries_do_not_depend_on_blocks(spark):
    """Entries over several blocks, blocks without a header, headers at block borders: one row each."""
    lines = (["  before"] * 3 + ["17/03/29 10:04:41 INFO A: x"] + [f"  c{i}" for i in range(9)]
             + ["17/03/29 10:04:42 INFO B: y", "17/03/29 10:04:43 INFO C: z", "  c", "17/03/29 10:04:44 INFO D: z"])
    whole = _entries(RC.stitched_entries(_logs(spark, lines)))
    assert len(whole) == 3 + 4 and whole[3][1] == 10 and whole[3][3] == "\n".join(lines[3:13])
    for n in (1, 2, 3, 4, 5, 7):
        assert _entries(RC.stitched_entries(_logs(spark, lines), block_lines=n)) == whole


def test_headerless_file_stays_single_lines(spark):
    a = _entries(RC.stitched_entries(_logs(spark, [f"  c{i}" for i in range(10)]), block_lines=3))
    assert a == [(i, 1, False, f"  c{i}") for i in range(10)]


def test_finished_without_time_counts_as_finished(spark):
    logs = _logs(spark, ["17/01/01 00:00:00 INFO executor.Executor: Running task 0.0 in stage 1.0 (TID 1)",
                         "executor.Executor: Finished task 0.0 in stage 1.0 (TID 1)"])
    t = TK.task_lifecycle(logs).first()
    assert t["finished"] and t["duration_sec"] is None
    assert TK.unfinished_tasks(logs).first()["unfinished_tasks"] == 0


def test_event_table_gives_the_same_results_as_lines(spark, fixture_lines):
    """Each operator over the one-pass event table equals the same operator over the lines."""
    from logscope.jobs.events import BY_EVENT
    events = EV.event_table(fixture_lines)
    for name, fn in BY_EVENT.items():
        a, b = fn(events), fn(fixture_lines)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
    assert sorted(map(str, TK.task_lifecycle(events).collect())) == sorted(map(str, TK.task_lifecycle(fixture_lines).collect()))


def test_line_of_two_kinds_gives_two_events(spark):
    logs = _logs(spark, ["17/01/01 00:00:00 ERROR executor.Executor: Running task 0.0 in stage 1.0 (TID 1) and Found block rdd_1_2 locally"])
    ev = {r["kind"]: r["g"] for r in EV.parse_events(logs).collect()}
    assert ev == {"error": [""], "task": ["Running", "0", "0", "1", "0", "1"], "cache_hit": ["rdd_1_2", "locally"]}
    assert EV.cache_hits_by_rdd(logs).first()["rdd_id"] == 1


def test_parse_audit(spark):
    logs = _logs(spark, ["17/03/29 10:04:41 INFO A: x", "   at x", "INFO no time"])
    a = RC.parse_audit(logs).first()
    assert (a["num_lines"], a["no_timestamp"], a["no_level"], a["no_component"]) == (3, 2, 1, 2)


def test_malformed_numbers_do_not_fail_the_job(spark):
    logs = _logs(spark, [
        "17/03/29 10:04:43 INFO YarnAllocator: Will request 99999999999999999999999 executor containers, "
        "each with 5 cores and 1024 MB memory",
        "17/03/29 10:11:10 INFO storage.MemoryStore: MemoryStore started with capacity 1.2.3 GB"])
    e = EV.executor_requests(logs).first()
    assert e["num_requests"] == 1 and e["total_executors"] is None and e["avg_cores"] == 5.0
    assert EV.memory_capacity(logs).first()["capacity_bytes"] is None


def test_fixture_goldens_sf001(spark):
    """Counts stated for the sf0.01 corpus: tasks and unfinished tasks, and the
    number of lines per message template."""
    from pyspark.sql import functions as F

    from logscope.sources import log_lines
    from conftest import SF_MID
    logs = log_lines(spark, SF_MID)
    t = TK.task_lifecycle(logs)
    assert t.count() == 2858 and t.filter("NOT finished").count() == 260
    assert EV.executor_requests(logs).agg(F.sum("num_requests")).first()[0] == 715
    assert EV.container_requests(logs).agg(F.sum("num_requests")).first()[0] == 715
    assert EV.input_splits(logs).agg(F.sum("num_splits")).first()[0] == 714
    assert EV.python_worker_times(logs).agg(F.sum("num_reports")).first()[0] == 714
    assert EV.broadcast_reads(logs).agg(F.sum("num_reads")).first()[0] == 714
    assert EV.shuffle_fetches(logs).agg(F.sum("num_reports")).first()[0] == 714
