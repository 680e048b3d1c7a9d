import os
import subprocess
import sys


def test_operators_survive_task_failures(tmp_dir):
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_check.py")
    env = dict(os.environ, RETRY_MARK_DIR=tmp_dir)
    out = subprocess.run([sys.executable, script, "/root/testdata/sf0.001"], capture_output=True, text=True, timeout=900, env=env)
    lines = out.stdout.strip().splitlines()
    assert lines and lines[-1] == "OK", out.stdout[-2000:] + out.stderr[-2000:]
    assert int(lines[-2].split()[1]) > 10
