"""Scratch folders and running away from the repository folder."""

import os
import subprocess
import sys
from pathlib import Path

from blockpulse.session import scratch_run, shared_path

ROOT = Path(__file__).resolve().parents[1]


def test_a_run_deletes_its_folders(spark):
    kept = shared_path(spark, "before")
    spark.range(3).write.parquet(kept)
    with scratch_run(spark):
        path = shared_path(spark, "inside")
        spark.range(3).write.parquet(path)
        assert Path(path).exists()
    assert not Path(path).exists() and Path(kept).exists()


def test_workers_find_the_package_from_another_folder(tmp_path):
    """Python workers import the package that the session shipped, not the working folder."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from blockpulse.session import local_session, ship_package
from blockpulse.operators.causality import granger
spark = local_session("2")
ship_package(spark)
pairs = spark.range(60).selectExpr("'a' AS feature", "date_add(DATE '2020-01-01', cast(id AS int)) AS ts", "pmod(hash(id), 100) * 1.0D AS x", "pmod(hash(id + 9), 70) * 1.0D AS y")
rows = granger(pairs, 2).collect()
assert len(rows) == 2 and all(r.p_value is not None for r in rows)
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=240, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable})
