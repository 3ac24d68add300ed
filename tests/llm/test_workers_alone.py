"""Executors do not need the package: the queries with Python workers run from a folder that does not hold it."""

import subprocess
import sys

from conftest import ROOT, SF

SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
names = [n for n in entry.queries() if n.split("_")[0] in ("op2", "op3", "op4", "op6", "op7", "op8", "op9", "op11", "op12", "op13")]
assert len(names) == 10
for name in names:
    assert entry.queries()[name](spark, {SF!r}).count() > 0, name
print("all ran")
"""


def test_workers_need_no_package(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=400)
    assert "all ran" in out.stdout, out.stderr[-2000:]
