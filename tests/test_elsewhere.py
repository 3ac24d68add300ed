"""Executors do not need the package: the queries run from a folder that does not hold it."""

import subprocess
import sys

from conftest import ROOT, SF

SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("knn_topk", "knn_self", "knn_lsh", "knn_cells", "anomaly_mahalanobis", "model_hooks"):
    assert entry.queries()[name](spark, {SF!r}).count() > 0, name
print("all ran")
"""


def test_workers_need_no_package(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert "all ran" in out.stdout, out.stderr[-2000:]
