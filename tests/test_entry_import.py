"""The driver reads the entry points in a process that has no Spark session."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as e
from pyspark import SparkContext
queries, oracles = e.queries(), e.oracle_sql()
assert SparkContext._active_spark_context is None
assert len(queries) > 50 and set(oracles) <= set(queries), set(oracles) - set(queries)
"""


def test_entry_points_need_no_session():
    done = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
