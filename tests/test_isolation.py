"""The library without the operators for training corpora."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
PROGRAM = """
import __spark_entry__ as entry
from roadpulse.plans import catalog
from oracle import oracle_sql
assert set(entry.queries()) == set(catalog.queries()) and set(entry.oracle_sql()) == set(oracle_sql())
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_works_without_them(tmp_path, pipeline):
    skip = ["llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])]
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns(*skip))
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_them():
    allowed = {"__spark_entry__.py", "corpus_pipeline.py"}
    for file in REPO.rglob("*.py"):
        inside = file.relative_to(REPO).as_posix()
        if inside not in allowed and not inside.startswith(("roadpulse/llm/", "tests/llm/", "tests/test_isolation")):
            assert "roadpulse.llm" not in file.read_text() and "corpus_pipeline" not in file.read_text(), inside
