import os
import subprocess
import sys

from conftest import SF_SMALL


def test_queries_survive_task_failures(tmp_dir):
    """Injected task failures (first attempt of half the tasks, in scans and after
    the last shuffle) are retried by Spark and every result equals a clean run."""
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_check.py")
    env = dict(os.environ, RETRY_MARK_DIR=tmp_dir)
    out = subprocess.run([sys.executable, script, SF_SMALL], capture_output=True, text=True, timeout=600, env=env)
    lines = out.stdout.strip().splitlines()
    assert lines and lines[-1] == "OK", out.stdout[-2000:] + out.stderr[-2000:]
    injected = int(lines[-2].split()[1])
    assert injected > 10, f"only {injected} failures were injected"
