"""The driver runs the queries from its own working directory with a plain session: Python workers must still find
the package (shipped with addPyFile)."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
assert E.entry(spark).count() > 0
n = E.queries()["knn_join_l2"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n)
spark.stop()
"""


def test_queries_run_from_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.gettempdir(), env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS" in out.stdout
