"""The library without its corpus operators: a copy that lacks their folders still works."""

import os
import shutil
import subprocess
import sys

import pytest

from viewtide.plans.catalog import load

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import __spark_entry__ as driver
from viewtide.session import build_session

names = set(driver.queries())
assert not [n for n in names if n.startswith("op") and n[2].isdigit()], names
assert "pipeline" not in names and set(driver.oracle_sql()) <= names
spark = build_session("copy", "local[2]", spark__sql__shuffle__partitions=2)
spark.sparkContext.setLogLevel("ERROR")
print("rows", driver.queries()["genre_performance"](spark, "/root/testdata/sf0.001").count(), len(names))
"""


@pytest.mark.parametrize("pipeline", [False, True])
def test_entry_file_works_without_the_corpus_operators(tmp_path, pipeline):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=left_out)
    assert not (copy / "viewtide" / "llm").exists() and not (copy / "tests" / "llm").exists()
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert f"rows 6 {len(load())}" in done.stdout
