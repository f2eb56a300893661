"""A session that names no shared folder."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
from pyspark.sql import SparkSession
from chainlens.session import checkpoint_dir
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
a, b = checkpoint_dir(s), checkpoint_dir(s)
assert a and b and a in b, (a, b)
s.range(3).write.parquet(b + "/t")
assert s.read.parquet(b + "/t").count() == 3
"""


def test_private_folder_of_local_sessions(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}  # no defaults of the machine
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=Path(__file__).resolve().parents[1],
                          env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
