import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from cohortlens.plans import registry
print("ROWS", registry.queries()["dcr_core"](s, "/root/testdata/sf0.001").count())
"""


def test_neighbour_search_runs_from_another_folder(tmp_path):
    """Workers import nothing of the package: its folder is on the driver's path only."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]
