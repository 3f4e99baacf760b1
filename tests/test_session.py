import os
import subprocess
import sys


def test_starts_without_a_configured_checkpoint_folder(tmp_path):
    """An empty configuration folder: no spark.checkpoint.dir from the machine."""
    code = ("from sessionlake.session import checkpoint_dir, get_spark\n"
            "s = get_spark(cpus=1)\n"
            "d = checkpoint_dir(s)\n"
            "assert d == checkpoint_dir(s)\n"
            "assert s.range(3).checkpoint().count() == 3\n"
            "print('started')\n")
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert "started" in got.stdout, got.stderr[-2000:]
