"""Executors that have no copy of the library: every operator's functions and broadcasts reach them by value."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
names = [n for n in entry.queries() if n.startswith("op")]
for name in names:
    entry.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
print("ran", len(names))
"""


def test_workers_need_no_copy_of_the_library(tmp_path):
    repo = str(Path(__file__).parent.parent.parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ended = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], capture_output=True, timeout=600, cwd=tmp_path, env=env)
    assert ended.returncode == 0 and b"ran 13" in ended.stdout, ended.stderr.decode()[-3000:]
