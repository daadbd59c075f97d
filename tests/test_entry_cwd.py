"""The driver may load the entry module by path from any working directory."""

import os
import subprocess
import sys
import tempfile

SCRIPT = r'''
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1])
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
rows = m.entry(spark).collect()
print("ROWS", len(rows))
spark.stop()
'''


def test_entry_from_foreign_working_directory():
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    cwd = tempfile.mkdtemp(prefix="entry-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT, entry], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 3" in res.stdout, res.stderr[-3000:]
