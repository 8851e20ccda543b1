import os
import subprocess
import sys


def test_hive_session(tmp_path):
    """Hive support is fixed when a session starts, so this runs in another process."""
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "hive_session.py")
    done = subprocess.run(
        [sys.executable, script, str(tmp_path)], capture_output=True, text=True, timeout=300, cwd=tmp_path
    )
    assert "hive ok" in done.stdout, done.stdout[-2000:] + done.stderr[-4000:]
