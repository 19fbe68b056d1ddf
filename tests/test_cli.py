"""The job entry point runs a registered query end to end in its own process."""

import os
import subprocess
import sys

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_query():
    out = subprocess.run(
        [sys.executable, "-m", "orderflow", "query", "validation_counts", "--data", SF_SMALL],
        cwd=REPO, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "valid_count" in out.stdout and "invalid_count" in out.stdout
