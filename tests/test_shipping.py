"""Code that runs in tasks must not need the package on the executors."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {cp!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate())
from vectorferry.queries import QUERIES
for name in ("encoder_custom_udf", "sink_connector"):
    assert QUERIES[name](spark, {sf!r}).count() > 0
print("fine")
"""


def test_queries_with_python_run_from_another_folder(folder, tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=repo, cp=str(tmp_path / "cp"), sf=folder)
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180
    )
    assert "fine" in done.stdout, done.stderr[-3000:]
