"""The entry's contract, as a process without a session sees it."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent


def test_queries_are_listed_without_a_session():
    code = """
import __spark_entry__ as entry
from pyspark import SparkContext
queries, sql = entry.queries(), entry.oracle_sql()
assert SparkContext._active_spark_context is None
assert set(sql) <= set(queries) and {"pipeline", "s2_try_normalize_id"} <= set(queries)
assert sum(name.startswith("op") and name[2].isdigit() for name in queries) == 13
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=100)
    assert done.returncode == 0, done.stderr
