"""The library, its entry and its tests work without the operators for training data and without the pipeline."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), sum(n.startswith('op') for n in q), 'pipeline' in q)"


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_llm(tmp_path, pipeline):
    at = tmp_path / "copy"
    gone = ["llm", ".git", "__pycache__", ".pytest_cache"] + ([] if pipeline else ["corpus_pipeline.py"])
    shutil.copytree(ROOT, at, ignore=lambda _, names: [n for n in names if n in gone])
    env = os.environ | {"PYTHONPATH": str(at)}
    said = subprocess.run([sys.executable, "-c", ASK], cwd=at, env=env, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    n, ops, has = said.stdout.split()
    assert int(n) > 50 and ops == "0" and has == "False"
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=at, env=env, capture_output=True, text=True)
    assert collected.returncode == 0, collected.stdout[-2000:]
