"""Lost tasks are retried without changing any result (see retry_job.py)."""

from __future__ import annotations

import os
import subprocess
import sys


def test_results_survive_task_failures():
    job = os.path.join(os.path.dirname(__file__), "retry_job.py")
    out = subprocess.run([sys.executable, job], capture_output=True, text=True, timeout=600)
    assert "RETRY-OK" in out.stdout, out.stderr[-3000:]
    assert "injected task failure" in out.stderr      # failures really happened
