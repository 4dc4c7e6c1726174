"""The driver contract must import and list queries before any Spark session exists."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_listed_without_spark():
    code = ("import __spark_entry__ as se; q = se.queries(); o = se.oracle_sql(); "
            "assert q and set(o) <= set(q); print(len(q))")
    r = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-2000:]
    assert int(r.stdout.strip().splitlines()[-1]) >= 80
