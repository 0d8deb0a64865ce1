"""The entry file without the optional subpackage, its tests or the pipeline file."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
LISTS = "import __spark_entry__ as e; print(len(e.queries()), *sorted(e.queries()))"


def copy(tmp_path, *gone):
    there = tmp_path / "repo"
    shutil.copytree(REPO, there, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse"))
    for name in gone:
        path = there / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    return there


def run(there, *command):
    env = {**os.environ, "PYTHONPATH": str(there)}
    out = subprocess.run([sys.executable, *command], cwd=there, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stdout + out.stderr
    return out.stdout


@pytest.mark.parametrize("gone", [("adspend/llm", "tests/llm"), ("adspend/llm", "tests/llm", "corpus_pipeline.py"),
                                  ("tests/llm", "corpus_pipeline.py")])
def test_own_queries_stay(tmp_path, gone):
    from adspend.testkit.registry import QUERIES

    there = copy(tmp_path, *gone)
    n, *names = run(there, "-c", LISTS).split()
    assert set(QUERIES) <= set(names) and int(n) == len(names)
    if "adspend/llm" in gone:
        assert set(names) == set(QUERIES)
    collected = run(there, "-m", "pytest", "tests", "--collect-only", "-q")
    assert "test_query_matches_oracle" in collected and "error" not in collected
