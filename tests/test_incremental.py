"""Incremental manifests, accounting of files read in part, duration density."""
import gzip
import math
import os
import shutil

import numpy as np
import pytest

from logscope.operators import timeline as TL
from logscope.sources import gzip_text_bytes, list_logs, read_accounting, read_logs, read_logs_numbered
from logscope.sources.incremental import read_manifest, update_manifest

APP = "application_1485248649253_{:04d}"


def write(root, app, container, lines, mode="w"):
    folder = os.path.join(root, APP.format(app))
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"container_1485248649253_{app:04d}_01_{container:06d}.log")
    with open(path, mode) as f:
        f.write("".join(f"{x}\n" for x in lines))
    return path


def line(minute, text="INFO a.B: x"):
    return f"17/03/01 10:{minute:02d}:00 {text}"


def bytes_read(spark):
    """Bytes that finished tasks have read from files, by the status store."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).inputBytes() for i in range(stages.size()))


def timeline(manifest):
    cols = ["cluster_id", "application_id", "app_number", "start_time", "end_time"]
    return sorted(map(tuple, TL.app_timeline_from_files(manifest).select(cols).collect()))


def full(spark, root):
    return sorted(map(tuple, TL.app_timeline(read_logs(spark, root), ordered=False).collect()))


def test_runs_read_only_what_is_new_and_equal_a_full_run(spark, tmp_path):
    root, state = str(tmp_path / "logs"), str(tmp_path / "state")
    assert read_manifest(spark, state).count() == 0
    for app in range(1, 6):
        write(root, app, 1, [line(app + i) for i in range(200 if app == 1 else 3)][:40])
    write(root, 7, 1, ["no time here"])
    write(root, 8, 1, [])
    one = update_manifest(spark, root, state)
    assert (one.version, one.files_listed, one.files_read) == (1, 6, 6) and one.bytes_read == one.bytes_listed
    assert timeline(one.manifest) == full(spark, root)
    # nothing new: nothing is read, not even the timeless file (Spark lists no file without bytes)
    two = update_manifest(spark, root, state)
    assert (two.version, two.files_read, two.bytes_read) == (2, 0, 0) and timeline(two.manifest) == full(spark, root)
    # a new file with an odd name, a grown one, one that is gone
    new = write(root, 9, 2, [line(50), line(59)])
    odd = os.path.join(os.path.dirname(new), "container_1485248649253_0009_01_000003 a+b[1]*{x}.log")
    shutil.copy(new, odd)
    grown = write(root, 2, 1, [line(58)], mode="a")
    os.remove(os.path.join(root, APP.format(5), os.listdir(os.path.join(root, APP.format(5)))[0]))
    three = update_manifest(spark, root, state)
    assert three.files_read == 3 and three.bytes_read == sum(map(os.path.getsize, (new, odd, grown)))
    assert timeline(three.manifest) == full(spark, root) and three.files_listed == 7
    rows = {r["path"].rsplit("/", 1)[1]: r for r in read_manifest(spark, state).collect()}
    assert len(rows) == 7 and rows[os.path.basename(grown)]["num_lines"] == 4


def test_a_second_run_scans_the_added_bytes_only(spark, tmp_path):
    root, state = str(tmp_path / "logs"), str(tmp_path / "state")
    for app in range(1, 4):
        write(root, app, 1, [line(i % 60, "INFO a.B: " + "x" * 200) for i in range(3000)])
    update_manifest(spark, root, state)
    added = os.path.getsize(write(root, 4, 1, [line(i % 60) for i in range(500)]))
    before = bytes_read(spark)
    got = update_manifest(spark, root, state)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    read = bytes_read(spark) - before
    # the manifest and the listing are small tables of their own, read a few times
    assert got.bytes_read == added and added <= read < added + 200_000 < 3 * 3000 * 200


def test_an_unfinished_version_does_not_count(spark, tmp_path):
    root, state = str(tmp_path / "logs"), str(tmp_path / "state")
    write(root, 1, 1, [line(1)])
    update_manifest(spark, root, state)
    os.makedirs(f"{state}/v=2")
    assert read_manifest(spark, state).count() == 1
    assert update_manifest(spark, root, state).version == 2


def test_accounting_names_files_read_whole_in_part_and_not_at_all(spark, tmp_path):
    root = tmp_path / "logs"
    write(str(root), 1, 1, ["a", "", "b c"])
    (root / "crlf.log").write_bytes(b"one\r\ntwo\r\n")
    (root / "open.log").write_bytes(b"no break at the end")
    (root / "empty.log").write_bytes(b"")
    text = "".join(f"line {i} {'y' * (i % 50)}\n" for i in range(20000)).encode()
    (root / "whole.log.gz").write_bytes(gzip.compress(text))
    (root / "cut.log.gz").write_bytes(gzip.compress(text)[:-9000])
    (root / "bad.log.gz").write_bytes(b"this is no gzip file at all, but it has bytes")
    logs, listing = read_logs(spark, str(root)), list_logs(spark, str(root))
    got = {os.path.basename(r["path"]): r for r in read_accounting(logs, listing, gzip_text_bytes(spark, str(root))).collect()}
    status = {k: r["status"] for k, r in got.items()}
    cut = status.pop("cut.log.gz")
    assert status == {"container_1485248649253_0001_01_000001.log": "whole", "crlf.log": "whole", "open.log": "whole",
                      "whole.log.gz": "whole", "bad.log.gz": "unread"}
    assert cut in ("part", "unread", "changed") and cut != "whole"
    assert got["whole.log.gz"]["text_bytes"] == len(text) and got["whole.log.gz"]["missing_bytes"] == 0
    # a file without bytes is in no listing of Spark's; another listing may have it
    more = listing.select("path", "file_size").unionByName(spark.createDataFrame([("/x/empty.log", 0)], "path string, file_size long"))
    assert {r["status"] for r in read_accounting(logs, more).collect() if "empty" in r["path"]} == {"empty"}
    # without their text sizes compressed files are not judged
    assert {r["status"] for r in read_accounting(logs, listing).collect() if "whole.log.gz" in r["path"]} == {"unknown"}
    # lines of a file that another reading has lost
    lost = read_accounting(logs.filter("line != 'b c'"), listing).filter("path LIKE '%000001.log'").first()
    assert (lost["status"], lost["missing_bytes"]) == ("part", 2)


def test_numbering_reads_the_text_once(spark, tmp_path):
    root = str(tmp_path / "logs")
    path = write(root, 1, 1, [line(i % 60, f"INFO a.B: {i}") for i in range(500)])
    df = read_logs_numbered(spark, root)
    assert "Scan text" not in df._jdf.queryExecution().executedPlan().toString()       # stored: lines and offsets from one reading
    os.remove(path)
    got = sorted((r["line_no"], r["line"]) for r in df.collect())
    assert [g[0] for g in got] == list(range(500)) and got[499][1].endswith(": 499")


def kernel(values, points=200):
    v = np.log10([x for x in values if x > 0])
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min() - 3 * h, v.max() + 3 * h, points)
    return x, np.exp(-((x[:, None] - v) / h) ** 2 / 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi)), h


def test_density_is_close_to_the_exact_kernel_sum_with_area_one(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([10 ** rng.normal(1, 0.4, 3000), 10 ** rng.normal(2.5, 0.2, 1000), [0.0, -3.0]]).tolist()
    df = spark.createDataFrame([(x,) for x in values] + [(None,)], "m double")
    got = sorted(TL.log_density(df, "m").collect())
    x, want, h = kernel(values)
    assert len(got) == 200 and got[0]["n"] == 4000 and abs(got[0]["bandwidth"] - h) < 1e-12
    assert np.allclose([r["log10_x"] for r in got], x) and np.abs(np.array([r["density"] for r in got]) - want).max() < 2e-3 * want.max()
    d = np.array([r["density"] for r in got])
    area = ((d[1:] + d[:-1]) / 2 * np.diff(x)).sum()
    assert abs(area - 1) < 2e-3


@pytest.mark.parametrize("values", [[], [5.0], [5.0, 5.0, 5.0], [0.0, -1.0]])
def test_no_density_without_spread(spark, values):
    assert TL.log_density(spark.createDataFrame([(x,) for x in values], "m double"), "m").collect() == []


def test_tree_is_written_by_as_many_tasks_as_its_lines_need(spark, tmp_path, monkeypatch):
    from logscope.sources import fixture
    monkeypatch.setattr(fixture, "LINES_PER_TREE_TASK", 10)
    lines = [(f"/logs/{APP.format(a)}/container_1485248649253_{a:04d}_01_000001.log", i, line(i, f"INFO a.B: {a} {i}"))
             for a in range(1, 61) for i in (2, 0, 1)]
    fixture.write_tree(spark.createDataFrame(lines, fixture.CORPUS_SCHEMA).repartition(3), str(tmp_path / "tree"))
    tasks = max(spark.sparkContext.defaultParallelism, 18)
    files = sorted((tmp_path / "tree").glob("app=*/*.txt"))
    # the part number is the task's: AQE has not merged the small partitions
    assert len(files) == 60 and len({f.name.split("-")[1] for f in files}) > tasks // 2
    assert all(f.read_text().splitlines() == [line(i, f"INFO a.B: {a} {i}") for i in range(3)] for a, f in enumerate(files, 1))


def test_a_tree_of_many_folders_is_listed_by_few_tasks(spark, tmp_path):
    from logscope.sources.logs import listing_tasks
    name, root = "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tmp_path / "logs")
    for app in range(1, 51):
        write(root, app, 1, [line(1)])
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")       # Spark's default, in a session without the library's profile
    try:
        with listing_tasks(spark, 7):
            assert spark.conf.get(name) == "7"
        assert spark.conf.get(name) == "10000"
        for read in (read_logs, list_logs):
            assert read(spark, root).count() == 50 and spark.conf.get(name) == "10000"
        with listing_tasks(spark, 20000):
            assert spark.conf.get(name) == "10000"
    finally:
        spark.conf.set(name, before)


def accounted(spark, root):
    return read_accounting(read_logs(spark, root), list_logs(spark, root, glob_filter="*.log"))


def test_a_tree_of_many_folders_is_read_part_by_part(spark, tmp_path, monkeypatch):
    from logscope.sources import by_parts, logs
    root = tmp_path / "logs, [1]"
    for app in range(1, 12):
        write(str(root), app, 1, [line(app), "", "x"])
    for name in ("a,b", "c[d]{e}*", "f g?", "h\\i", "k=%20", "_hidden", ".hidden", "_p=1"):
        (root / name / "deep").mkdir(parents=True)
        (root / name / "deep" / "one.log").write_text("one\ntwo")
    (root / "own.log").write_text("beside the folders\n")
    (root / "own.txt").write_text("no log\n")
    (root / "empty").mkdir()
    at = logs.exact_path(str(root))
    want = sorted(map(tuple, accounted(spark, at).collect()))
    assert list(logs.tree_parts(spark, at)) == [at]         # few folders: as before
    monkeypatch.setattr(logs, "PATHS_AT_ONCE", 4)
    parts = list(logs.tree_parts(spark, at))
    assert len(parts) > 4 and all(isinstance(p, list) and len(p) <= 4 for p in parts)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    got = by_parts(spark, at, lambda part: accounted(spark, part))
    assert sorted(map(tuple, got.collect())) == want and len(want) == 18 and {k: spark.conf.get(k, None) for k in before} == before
    # paths that a glob matches are divided as they are, roots that may hold one another are not
    some = list(logs.tree_parts(spark, f"{at}/app*", recursive=False))
    assert sorted(x.rsplit("_", 1)[1] for p in some for x in p) == [f"{a:04d}" for a in range(1, 12)]
    for whole in ([at, f"{at}/app*"], f"{{{tmp_path}/x,{tmp_path}}}", f"{at}/none"):
        assert list(logs.tree_parts(spark, whole)) == [whole]


def test_no_listing_stays_when_its_frame_is_gone(spark):
    from logscope.sources.logs import listing_tasks
    name = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(name)
    with listing_tasks(spark):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name) == before


def test_a_tree_has_no_checksum_files(spark, tmp_path):
    from logscope.sources import fixture
    lines = [(f"/logs/{APP.format(a)}/container_1485248649253_{a:04d}_01_000001.log", 0, line(a)) for a in range(1, 4)]
    fixture.write_tree(spark.createDataFrame(lines, fixture.CORPUS_SCHEMA), str(tmp_path / "tree"))
    files = sorted(f.name for f in (tmp_path / "tree").glob("app=*/*")) + sorted(f.name for f in (tmp_path / "tree").glob("app=*/.*"))
    assert len(files) == 3 and all(f.endswith(".txt") for f in files)


def test_a_manifest_reads_a_part_of_its_files_at_a_time(spark, tmp_path, monkeypatch):
    from logscope.sources import incremental, logs
    for module in (logs, incremental):
        monkeypatch.setattr(module, "PATHS_AT_ONCE", 4)
    asked = []
    for name in ("read_logs", "list_logs"):
        real = getattr(incremental, name)
        monkeypatch.setattr(incremental, name, lambda spark, root, real=real, **k: asked.append(root) or real(spark, root, **k))
    root, state = str(tmp_path / "logs"), str(tmp_path / "state")
    for app in range(1, 12):
        write(root, app, 1, [line(app), line(app + 20)])
        write(root, app, 2, [line(app + 40)])
    one = update_manifest(spark, f"{root}/application_*_000[1-5]", state)
    two = update_manifest(spark, root, state)
    grown = write(root, 3, 2, [line(59)], mode="a")
    three = update_manifest(spark, root, state)
    four = update_manifest(spark, root, state)
    assert [(u.files_listed, u.files_read) for u in (one, two, three, four)] == [(10, 10), (22, 12), (22, 1), (22, 0)]
    assert three.bytes_read == os.path.getsize(grown) and two.bytes_read == two.bytes_listed - one.bytes_listed
    assert timeline(four.manifest) == full(spark, root) and len(full(spark, root)) == 11
    # the driver never holds the whole listing: no frame has more than four paths, none is over the tree itself
    assert all(isinstance(r, list) and len(r) <= 4 for r in asked) and len(asked) > 12


def test_a_listing_is_stored_without_a_shuffle(spark, tmp_path, monkeypatch):
    from logscope.sources import incremental
    stored, real = [], incremental.materialize_all
    monkeypatch.setattr(incremental, "materialize_all", lambda spark, frames: real(spark, [stored.append(f) or f for f in frames]))
    root = str(tmp_path / "logs")
    for app in range(1, 301):
        write(root, app, 1, [line(1)])
    assert update_manifest(spark, root, str(tmp_path / "state")).files_read == 300
    plan = stored[0]._jdf.queryExecution().executedPlan().toString()
    # no more table files than cores all the same
    assert "binary" in plan.lower() and "Exchange" not in plan and stored[0].rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_a_part_is_gone_before_the_next_is_read(spark, tmp_path):
    import weakref

    from logscope.session import materialize_all
    root = str(tmp_path / "logs")
    for app in range(1, 5):
        write(root, app, 1, [line(app)])
    refs, alive = [], []

    def make(app):
        alive.append(sum(r() is not None for r in refs))
        f = accounted(spark, os.path.join(root, APP.format(app)))
        refs.append(weakref.ref(f._jdf))        # while it is there, the driver keeps the listing
        return f

    assert materialize_all(spark, map(make, range(1, 5))).count() == 4 and alive == [0, 0, 0, 0]
