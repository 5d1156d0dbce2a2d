"""The driver imports __spark_entry__.py by path from its own working
directory with its own session; queries that run library code in Python
workers must still work (the package is shipped to the workers)."""

import json
import os
import subprocess
import sys

from tests.conftest import SF_SMALL

SCRIPT = r'''
import importlib.util, json, sys
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1])
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
q = m.queries()
print(json.dumps({k: q[k](spark, sys.argv[2]).count()
                  for k in ["tile_explode", "page_links", "expected_count"]}))
'''


def test_queries_from_another_directory(tmp_path):
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                         "__spark_entry__.py")
    script = tmp_path / "drive.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script), entry, SF_SMALL], cwd=str(tmp_path),
                         env=env, capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert lines, out.stderr[-3000:]
    got = json.loads(lines[-1])
    assert got["tile_explode"] > 0 and got["page_links"] > 0 and got["expected_count"] > 0
