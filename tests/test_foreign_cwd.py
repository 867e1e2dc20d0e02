"""The driver may load __spark_entry__.py by path from another directory:
the Python hops must still run (their code travels with the tasks)."""
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", m.queries()["page_stats"](spark, "/root/testdata/sf0.001").count(),
      m.entry(spark).count())
"""


def test_queries_run_when_loaded_from_elsewhere():
    cwd = tempfile.mkdtemp(prefix="qbank-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("ROWS")]
    assert line, out.stderr[-2000:]
    _, pages, entry_rows = line[0].split()
    assert int(pages) == 50 and int(entry_rows) > 0
