"""Concurrency, busy spells and memory states against plain loops; a hot key spreads over its time ranges."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logscope.operators import activity as AC
from logscope.operators.running import time_bucket, with_running
from logscope.session import materialize

T0 = dt.datetime(2017, 3, 1, 23, 59, 30)
INTERVALS = "cluster_id string, container_id string, start_time timestamp_ntz, end_time timestamp_ntz"
TASKS = "application_id string, container_id string, start_time timestamp_ntz, end_time timestamp_ntz"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def some(seed, n=80, keys="ab"):
    """Intervals of which key ``a`` has most; many share instants, touch, or are empty."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = rng.randint(0, 60) / rng.choice((1, 2))
        out.append((rng.choice(keys[:1] * 8 + keys[1:]), f"c{i}", at(a), at(a + rng.choice((0, 0, 1, 5, 17, 40.25)))))
    return out


@pytest.mark.parametrize("seed,width", [(1, 1), (2, 7), (3, 3600)])
def test_concurrency_equals_counting(spark, seed, width):
    rows = some(seed) + [("", "none", at(0), at(9)), ("a", "untimed", None, None)]
    df = spark.createDataFrame(rows, INTERVALS)
    got = {r["cluster_id"]: r for r in AC.concurrency_by_cluster(df, width).collect()}
    assert set(got) == {"a", "b"}
    for k, r in got.items():
        iv = [(s, e) for c, _, s, e in rows if c == k and s]
        count = lambda t: sum(s <= t <= e for s, e in iv)
        peak = max(count(s) for s, _ in iv)
        first, last = min(s for s, _ in iv), max(e for _, e in iv)
        assert (r["num_containers"], r["peak_containers"]) == (len(iv), peak)
        assert r["peak_time"] == min(s for s, _ in iv if count(s) == peak)
        total = sum((e - s).total_seconds() for s, e in iv)
        assert abs(r["mean_containers"] - total / (last - first).total_seconds()) < 1e-9 and abs(r["container_sec"] - total) < 1e-9
    for r in AC.concurrency_over_time(df, width).collect():
        iv = [(s, e) for c, _, s, e in rows if c == r["cluster_id"] and s]
        lo, hi = r["range_start"], r["range_start"] + dt.timedelta(seconds=width)
        assert (lo - dt.datetime(1970, 1, 1)).total_seconds() % width == 0
        before = sum(s < lo <= e for s, e in iv)
        inside = [sum(s <= t <= e for s, e in iv) for t, _ in iv if lo <= t < hi]
        area = sum(max(0.0, (min(e, hi) - max(s, lo)).total_seconds()) for s, e in iv)
        assert (r["open_before"], r["peak_containers"]) == (before, max([before, *inside]))
        assert (r["started"], r["ended"]) == (sum(lo <= s < hi for s, _ in iv), sum(lo <= e < hi for _, e in iv))
        assert abs(r["mean_containers"] - area / width) < 1e-9


@pytest.mark.parametrize("seed,width", [(4, 1), (5, 9), (6, 3600)])
def test_spells_equal_merging_intervals(spark, seed, width):
    rows = some(seed, 60)
    df = spark.createDataFrame(rows, TASKS)
    keys = {r[:2] for r in rows}
    one = df.withColumn("container_id", F.lit("k"))          # one hot container per application
    spells, activity = {}, {(r["application_id"], r["container_id"]): r for r in AC.container_activity(one, width).collect()}
    for r in AC.busy_spells(one, width).collect():
        spells.setdefault(r["application_id"], []).append(r)
    assert len(keys) == 60 and set(activity) == {("a", "k"), ("b", "k")}
    for k in "ab":
        want = []
        for s, e in sorted((s, e) for c, _, s, e in rows if c == k):
            if want and s <= want[-1][1]:
                want[-1][1:] = [max(want[-1][1], e), want[-1][2] + 1]
            else:
                want.append([s, e, 1])
        got = sorted(spells[k], key=lambda r: r["spell"])
        assert [[r["spell_start"], r["spell_end"], r["num_tasks"]] for r in got] == want
        assert [r["spell"] for r in got] == list(range(1, len(want) + 1))
        gaps = [(b[0] - a[1]).total_seconds() for a, b in zip(want, want[1:])]
        r = activity[k, "k"]
        assert (r["num_spells"], r["num_tasks"]) == (len(want), sum(w[2] for w in want))
        assert abs(r["idle_sec"] - sum(gaps)) < 1e-9 and abs(r["longest_gap_sec"] - max(gaps, default=0)) < 1e-9
        assert abs(r["busy_sec"] - sum((e - s).total_seconds() for s, e, _ in want)) < 1e-9


LINES = [("x", "17/03/01 10:00:05 INFO storage.MemoryStore: Block rdd_1_1 stored as values in memory (estimated size 1.0 KB, free 2.0 MB)"),
         ("x", "17/03/01 10:00:10 INFO storage.MemoryStore: MemoryStore started with capacity 4.0 MB"),
         ("x", "17/03/01 10:00:10 INFO storage.MemoryStore: Block rdd_1_2 stored as bytes in memory (estimated size 1.0 KB, free 2.0 MB)"),
         ("x", "17/03/01 11:30:00 INFO storage.MemoryStore: MemoryStore started with capacity 8.0 MB"),
         ("x", "17/03/01 11:30:00 INFO storage.MemoryStore: MemoryStore started with capacity 6.0 MB"),
         ("x", "17/03/02 11:30:01 INFO storage.MemoryStore: Block broadcast_0 stored as values in memory (estimated size 2.0 KB, free 1.0 MB)"),
         ("x", "no time: Block rdd_9_9 stored as values in memory (estimated size 1.0 KB, free 1.0 KB)"),
         ("y", "17/03/01 10:00:06 INFO storage.MemoryStore: Block rdd_1_1 stored as values in memory (estimated size 1.0 KB, free 2.0 MB)")]


@pytest.mark.parametrize("width", [1, 3600, 10 ** 7])
def test_memory_states_take_the_latest_capacity(spark, width):
    path = "/logs/application_1485248649253_0001/container_1485248649253_0001_01_00000{}.log"
    logs = spark.createDataFrame([(path.format({"x": 1, "y": 2}[c]), i, line) for i, (c, line) in enumerate(LINES)],
                                 "path string, line_no long, line string")
    states = AC.memory_states(logs, width)
    got = {(r["container_id"][-1], r["block_id"]): r for r in states.collect()}
    mb = 1024.0 ** 2
    assert {k: (r["capacity_bytes"], r["free_share"]) for k, r in got.items()} == {
        ("1", "rdd_1_1"): (None, None), ("1", "rdd_1_2"): (4 * mb, 0.5), ("1", "broadcast_0"): (8 * mb, 0.125),
        ("1", "rdd_9_9"): (None, None), ("2", "rdd_1_1"): (None, None)}
    low = {r["container_id"][-1]: r for r in AC.memory_lows(states).collect()}
    assert (low["1"]["num_blocks"], low["1"]["blocks_with_capacity"], low["1"]["min_free_share"]) == (4, 2, 0.125)
    assert low["1"]["min_free_bytes"] == 1024.0 and low["2"]["min_free_share"] is None


def test_empty_frames(spark):
    none = spark.createDataFrame([], INTERVALS)
    assert AC.concurrency_by_cluster(none).collect() == [] and AC.concurrency_over_time(none).collect() == []
    assert AC.container_activity(spark.createDataFrame([], TASKS)).collect() == []
    assert AC.memory_states(spark.createDataFrame([], "path string, line_no long, line string")).collect() == []


def test_running_values_carry_over_buckets_and_hot_keys_spread(spark):
    rows = spark.range(0, 4000).selectExpr("'hot' AS k", "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) AS ts", "id % 7 AS v")
    rows = materialize(rows.withColumn("b", time_bucket("ts", 100)))
    out = with_running(rows, ["k"], "b", ["ts"], {"s": (F.sum, F.col("v"), True), "m": (F.max, F.col("v"), False)})
    got = [(r["s"], r["m"]) for r in out.orderBy("ts").collect()]
    total, most, want = 0, None, []
    for i in range(4000):
        want.append((total + i % 7, most))
        total, most = total + i % 7, max(most or 0, i % 7)
    assert got == want
    # the windows over rows are dealt by key and bucket, so the hot key is many tasks' work
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and ", b" in plan
    with pytest.raises(ValueError):
        with_running(rows, ["k"], "b", ["ts"], {"a": (F.avg, F.col("v"), True)})
