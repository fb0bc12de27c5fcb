"""The job CLI (H7) as a separate process: ``python -m logscope.jobs``."""
import os
import subprocess
import sys

from conftest import ROOT


def _run(args, tmp_path):
    env = dict(os.environ, PYTHONPATH=ROOT)
    p = subprocess.run([sys.executable, "-m", "logscope.jobs", *args, "--master", "local[2]"],
                       cwd=ROOT, env=env, capture_output=True, text=True, timeout=600)
    assert p.returncode == 0, p.stderr[-2000:]
    return p.stdout


def test_cli_levels_and_usage(log_tree, tmp_path):
    out = str(tmp_path / "out")
    _run(["levels", "--in", log_tree, "--out", out, "--seed", "1", "--crlf"], tmp_path)
    raw = open(f"{out}/level_counts.csv", newline="").read()
    assert raw == "log_level,count\r\nINFO,749\r\nWARN,187\r\nERROR,201\r\nDEBUG,63\r\n"
    _run(["usage", "--in", log_tree, "--out", out], tmp_path)
    assert open(f"{out}/usage_stats.txt").read().splitlines()[1] == "Total applications: 15"
    _run(["usage", "--in", log_tree, "--out", out, "--skip-scan"], tmp_path)
    assert os.path.exists(f"{out}/duration_histogram.csv")
