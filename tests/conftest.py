from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from refinery.session import build_session  # noqa: E402

GOLDEN = os.path.join(ROOT, "tests", "data", "golden.jsonl")
SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    logs = tempfile.mkdtemp(prefix="run-eventlog-")
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="refinery-tests",
                      event_log_dir=logs)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden_bronze(spark):
    """Bronze loaded from the hand-written JSON-lines file."""
    from refinery.session import fresh_workspace
    from refinery.sources.staged import load_bronze
    path = f"{fresh_workspace(spark, 'golden')}/bronze"
    load = load_bronze(spark, GOLDEN, path, load_time="2024-06-30 00:00:00")
    return path, load
