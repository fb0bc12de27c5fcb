"""Stage precedence, critical paths and line shapes against plain loops."""
import datetime as dt
import random

import pytest

from logscope.operators import precedence as PR
from logscope.operators import shapes as SH
from logscope.session import materialize

T0 = dt.datetime(2024, 1, 1, 23, 0, 0)
TASKS = "application_id string, stage_id long, start_time timestamp_ntz, end_time timestamp_ntz"


def brute(stages):
    """(edges, best (us, path)) of {stage: (a, z)}."""
    def before(x, y):
        (a, z), (b, c) = stages[x], stages[y]
        return x != y and (z < b or (z == b and not (a == z and b == c and x > y)))
    pairs = {(x, y) for x in stages for y in stages if before(x, y)}
    edges = {(x, y) for x, y in pairs if not any((x, k) in pairs and (k, y) in pairs for k in stages)}
    length = {s: int((z - a).total_seconds() * 1e6) for s, (a, z) in stages.items()}
    chains, best = [([s], length[s]) for s in stages], None
    while chains:
        path, us = chains.pop()
        rank = (us, len(path), [-x for x in reversed(path)])
        best = max(best, (rank, path)) if best else (rank, path)
        chains += [(path + [y], us + length[y]) for x, y in edges if x == path[-1]]
    return edges, best


@pytest.mark.parametrize("seed", range(4))
def test_edges_and_paths_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(PR, "BLOCK", 3)
    monkeypatch.setattr(PR, "WIDTH", 2)
    rng, rows, want = random.Random(seed), [], {}
    for app in "ab":
        stages = {}
        for s in rng.sample(range(20), 9 if app == "a" else 4):
            a = rng.randint(0, 20) * (400 if seed == 3 else 1)
            z = a + rng.choice((0, 0, 1, 3, 8))
            stages[s] = (T0 + dt.timedelta(seconds=a), T0 + dt.timedelta(seconds=z))
            rows += [(app, s, stages[s][0], stages[s][1])] * rng.randint(1, 2)
        want[app] = stages, brute(stages)
    rows += [("a", 99, None, T0), ("a", 98, T0, None), ("a", None, T0, T0)]
    spans = materialize(PR.stage_spans(spark.createDataFrame(rows, TASKS)))
    ranks = [x for r in spans.filter("application_id = 'a'").collect() for x in (r["s"], r["e"])]
    assert sorted(ranks) == list(range(1, 19))
    edges = materialize(PR.stage_precedence(spans))
    got = {}
    for r in edges.collect():
        got.setdefault(r["application_id"], set()).add((r["from_stage"], r["to_stage"]))
        a, b = want[r["application_id"]][0][r["from_stage"]], want[r["application_id"]][0][r["to_stage"]]
        assert r["wait_sec"] == (b[0] - a[1]).total_seconds() >= 0
    assert {k: got.get(k, set()) for k in want} == {k: w[1][0] for k, w in want.items()} and edges.count() == sum(map(len, got.values()))
    for r in PR.critical_paths(spans, edges).collect():
        stages, (_, (rank, path)) = want[r["application_id"]]
        assert (r["path"], r["path_stages"], r["num_stages"]) == (">".join(map(str, path)), len(path), len(stages))
        assert r["path_sec"] == rank[0] / 1e6 and 0 <= r["path_pct"] <= 100


def test_no_stages(spark):
    spans = materialize(PR.stage_spans(spark.createDataFrame([], TASKS)))
    assert PR.stage_precedence(spans).collect() == [] and PR.critical_paths(spans, PR.stage_precedence(spans)).collect() == []


def test_many_parallel_stages_do_not_meet_each_other(spark):
    """300 stages at once, then one: 300 edges, no pair among the 300."""
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [("a", i, at(0), at(10)) for i in range(300)] + [("a", 1000, at(20), at(30))]
    spans = materialize(PR.stage_spans(spark.createDataFrame(rows, TASKS)))
    edges = PR.stage_precedence(spans).collect()
    assert len(edges) == 300 and {r["to_stage"] for r in edges} == {1000}
    best = PR.critical_paths(spans, PR.stage_precedence(spans)).first()
    assert (best["path"], best["path_sec"]) == ("0>1000", 20.0)


def test_templates_keep_what_shapes_share(spark):
    lines = (["17/01/01 00:00:00 INFO a.B: parsed"] * 5 + ["    at frame click", "at frame view", "  at frame view  "]
             + ["Traceback in worker 12 at /usr/lib/a.py line 7", "Traceback in worker 9 at /usr/lib/python/b.py line 1,234"]
             + ["17/01/01 00:00:00 INFO no component", "", "17/01/01 00:00:00 nothing but deadbeefdeadbeef00 0x1F"])
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r["template"]: r for r in SH.unparsed_templates(df).collect()}
    assert set(got) == {"at frame <*>", "Traceback in worker <n> at <path> line <n>", "<n> <n> INFO no component", "", "<n> <n> nothing but <hex> <hex>"}
    assert (got["at frame <*>"]["num_lines"], got["at frame <*>"]["num_shapes"], got["at frame <*>"]["example"]) == (3, 2, "    at frame click")
    trace = got["Traceback in worker <n> at <path> line <n>"]
    assert (trace["num_lines"], trace["num_shapes"], trace["no_timestamp"], trace["no_level"], trace["no_component"]) == (2, 1, 2, 2, 2)
    assert (got["<n> <n> INFO no component"]["no_timestamp"], got["<n> <n> INFO no component"]["no_component"]) == (0, 1)
    deep = {r["template"] for r in SH.unparsed_templates(df, depth=3).collect()}
    assert {"at frame click", "at frame view"} <= deep
    assert SH.unparsed_templates(df.limit(0)).collect() == []
