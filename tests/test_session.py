"""The shared folder without spark.checkpoint.dir (fresh process, empty conf dir)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from prefweave.session import local_session, shared_root
spark = local_session("2")
assert spark.conf.get("spark.checkpoint.dir", None) is None
a = shared_root(spark)
b = shared_root(spark)
assert a == b and "prefweave-" in a, (a, b)
print("ROOT", a)
"""


def test_local_session_without_checkpoint_dir_gets_private_root():
    conf_dir = tempfile.mkdtemp(prefix="prefweave-emptyconf-")
    env = {**os.environ, "SPARK_CONF_DIR": conf_dir}
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True,
                         timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROOT " in out.stdout


def test_cluster_conf_sets_adaptive_execution():
    from prefweave.session import cluster_conf
    conf = cluster_conf(1234)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.shuffle.partitions"] == "1234"
