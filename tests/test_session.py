"""The library in a session that nobody prepared, started from another folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
import __spark_entry__
for name in ("trend_fold", "trend_stream", "sensor_rise_stream"):
    print(name, __spark_entry__.queries()[name](spark, {data!r}).count())
"""


def test_queries_run_in_a_plain_session_from_another_folder(tmp_path, small):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT, data=small)], cwd=tmp_path, env=env,
        capture_output=True, text=True, timeout=600,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith(("trend", "sensor")))
    assert set(counts) == {"trend_fold", "trend_stream", "sensor_rise_stream"}
    assert all(int(n) > 0 for n in counts.values())
