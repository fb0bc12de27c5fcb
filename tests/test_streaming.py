"""Streaming forms equal the batch operators, also after new files land."""
import shutil

from logscope.operators import levels as LV
from logscope.operators import timeline as TL
from logscope.sources import read_logs
from logscope.streaming import app_bounds_stream, level_totals_stream, read_logs_stream, start


def _apps(root):
    import os
    return sorted(d for d in os.listdir(os.path.join(root, "logs")) if d.startswith("application_"))


def test_stream_matches_batch(spark, log_tree, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    apps = _apps(log_tree)
    half = apps[: len(apps) // 2]
    for a in half:
        shutil.copytree(f"{log_tree}/logs/{a}", src / a)
    logs = read_logs_stream(spark, str(src))
    q1 = start(level_totals_stream(logs), "lvl_totals", output_mode="complete",
               checkpoint_location=str(tmp_path / "ck1"))
    q2 = start(app_bounds_stream(logs), "app_bounds", output_mode="update",
               checkpoint_location=str(tmp_path / "ck2"))
    try:
        for step in (half, apps[len(apps) // 2:]):
            for a in step:
                if not (src / a).exists():
                    shutil.copytree(f"{log_tree}/logs/{a}", src / a)
            q1.processAllAvailable()
            q2.processAllAvailable()
            batch = read_logs(spark, str(src))
            want = LV.level_totals(batch).first().asDict()
            got = spark.sql("SELECT * FROM lvl_totals").first().asDict()
            assert got == want
            latest = spark.sql("SELECT application_id, max(end_time) e, min(start_time) s FROM app_bounds "
                               "GROUP BY application_id").collect()
            tl = {r["application_id"]: (r["start_time"], r["end_time"])
                  for r in TL.app_timeline(batch).collect()}
            assert {r["application_id"]: (r["s"], r["e"]) for r in latest} == tl
    finally:
        q1.stop()
        q2.stop()


def test_stream_resumes_from_checkpoint(spark, log_tree, tmp_path):
    """A stopped query restarted on its checkpoint continues from its state:
    files seen before are not counted twice, new ones are added."""
    src = tmp_path / "incoming"
    src.mkdir()
    apps = _apps(log_tree)
    first, rest = apps[:5], apps[5:]
    for a in first:
        shutil.copytree(f"{log_tree}/logs/{a}", src / a)
    ck = str(tmp_path / "ck")

    def run_once():
        q = start(level_totals_stream(read_logs_stream(spark, str(src))), "lvl_resume", sink="memory",
                  output_mode="complete", checkpoint_location=ck)
        q.processAllAvailable()
        row = spark.sql("SELECT * FROM lvl_resume").first().asDict()
        q.stop()
        return row

    a = run_once()
    for x in rest:
        shutil.copytree(f"{log_tree}/logs/{x}", src / x)
    b = run_once()
    want = LV.level_totals(read_logs(spark, str(src))).first().asDict()
    # the memory sink is new on each run: the running totals come from the checkpointed state
    assert b == want and a["total_lines"] < b["total_lines"]
