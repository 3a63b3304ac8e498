"""The contract works from any directory, with a plain session and workers without the library."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as contract
assert contract.entry(spark).count() == 5
frame = contract.queries()["running_fraud_rate"](spark, "/root/testdata/sf0.001")
assert frame.count() == 1000 // 50 + 1
print("fine")
"""


def test_contract_from_another_directory(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)],
        cwd=tmp_path,
        env=env,
        capture_output=True,
        text=True,
        timeout=240,
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
