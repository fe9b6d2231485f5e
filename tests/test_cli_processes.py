"""The command-line jobs as separate processes, sharing state only through the table root."""

import os
import subprocess
import sys

from tidemark.sources import feed as feeds

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _job(*args):
    out = subprocess.run(
        [sys.executable, "-m", "tidemark.jobs", *args], cwd=REPO, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_jobs_as_processes(spark, workdir):
    feed_dir = os.path.join(workdir, "feed")
    feeds.fixture_feed(spark, SF_SMALL).write.parquet(feed_dir)
    root = os.path.join(workdir, "acct")
    _job("ingest", "--root", root, "--feed-path", feed_dir, "--mode", "once")
    assert "compact version=0 before=1251 invalidated=1096 after=155" in _job("compact", "--root", root)
    assert "report visible_rows=155" in _job("report", "--root", root)
