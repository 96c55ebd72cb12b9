from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent.parent


def test_workers_find_the_package_when_the_driver_starts_elsewhere(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert e.queries()["op1_secrets"](spark, "/root/testdata/sf0.001").count() == 200
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
