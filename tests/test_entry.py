"""The entry points can be imported and listed before any session exists."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


def test_listing_queries_needs_no_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) > 140; assert len(e.oracle_sql()) > 130"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.parametrize("pipeline", [True, False])
def test_stands_without_the_training_data_operators(tmp_path, pipeline):
    ours = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "repo", ignore=ours)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 155 and set(e.oracle_sql()) <= set(q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
