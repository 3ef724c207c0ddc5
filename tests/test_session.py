"""The package reaches the tasks from any working directory."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from __spark_entry__ import entry, queries
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", entry(spark).count(), queries()["response_gunzip"](spark, "/root/testdata/sf0.001").count())
"""


def test_queries_run_from_another_folder(tmp_path):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
    assert all(int(n) > 0 for n in done.stdout.split("rows")[1].split()[:2])
