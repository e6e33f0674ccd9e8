import os
import subprocess
import sys

import __spark_entry__ as entry

NAMES = {f"op{n}_" for n in range(1, 14)}


def test_a_query_for_each_operator():
    queries = entry.queries()
    assert {q.partition("_")[0] + "_" for q in queries if q.startswith("op")} == NAMES and "pipeline" in queries
    assert set(entry.oracle_sql()) <= set(queries)


def test_workers_find_the_package_from_any_folder(tmp_path):
    """A session that someone else made, in another folder and without this one on its path."""
    code = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, {os.path.dirname(os.path.abspath(entry.__file__))!r})
import __spark_entry__
print("rows", __spark_entry__.queries()["op7_secrets"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 200" in out.stdout, out.stderr[-2000:]
