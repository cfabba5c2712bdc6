"""The entry points without the optional operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(q.startswith('op') or q == 'pipeline' for q in e.queries()))"


@pytest.mark.parametrize("left", ["nothing", "empty folder", "cache folder"])
def test_without_the_optional_folder(tmp_path, left):
    for name in ("parcelwise", "workload"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if left != "nothing":
        (tmp_path / "parcelwise/llm").mkdir()
    if left == "cache folder":
        (tmp_path / "parcelwise/llm/__pycache__").mkdir()
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, capture_output=True, text=True, check=True, timeout=120)
    queries, oracles, optional = map(int, done.stdout.split())
    assert queries > 180 and oracles > 180 and optional == 0
