"""Checkpoint folder selection in a session without spark.checkpoint.dir."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from ledgerlens.session import build_session, checkpoint_root
import __spark_entry__ as E
spark = build_session("local[2]", 2)
assert spark.sparkContext.getConf().get("spark.checkpoint.dir") is None
root = checkpoint_root(spark)
assert root == checkpoint_root(spark)  # registered once, then reused
assert spark.range(5).checkpoint(eager=True).count() == 5
assert E.queries()["stream_bronze"](spark, "/root/testdata/sf0.001").count() == 1000
print("OK", root)
"""


def test_local_session_without_checkpoint_dir_gets_its_own_folder():
    conf_dir = tempfile.mkdtemp(prefix="ledgerlens-noconf-")  # no spark-defaults.conf
    env = dict(os.environ, SPARK_CONF_DIR=conf_dir)
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "OK " in out.stdout and "ledgerlens-ckpt-" in out.stdout
