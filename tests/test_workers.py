"""Worker-side Python (the scan source) works when the driver runs from another directory."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {entry!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
print("ROWS", entry.queries()["scan_items"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_scan_query_from_foreign_directory():
    cwd = tempfile.mkdtemp(prefix="tidemark-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    proc = subprocess.run([sys.executable, "-c", SCRIPT.format(entry=os.path.join(REPO, "__spark_entry__.py"))],
                          cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    rows = [ln for ln in proc.stdout.splitlines() if ln.startswith("ROWS ")]
    assert rows == ["ROWS 1000"], proc.stderr[-2000:]
