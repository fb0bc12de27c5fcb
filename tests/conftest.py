import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from logscope.session import ensure_checkpoint_dir, get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_session("local[*]", app_name="logscope-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    # the cluster names a shared folder; only when unset do tests provide one
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("checkpoints")))
    yield s


@pytest.fixture(scope="session")
def fixture_lines(spark):
    from logscope.sources import log_lines
    return log_lines(spark, SF_SMALL)


@pytest.fixture(scope="session")
def log_tree(spark, fixture_lines, tmp_path_factory):
    """The sf0.001 corpus written as a real log tree ``<root>/logs/application_*/container_*.log``
    (1,262 lines), so text sources are tested on files."""
    root = tmp_path_factory.mktemp("logtree")
    rows = fixture_lines.orderBy("path", "line_no").collect()
    files = {}
    for r in rows:
        files.setdefault(r["path"], []).append(r["line"])
    for p, lines in files.items():
        f = root / p.lstrip("/")
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("\n".join(lines) + "\n")
    return str(root)
