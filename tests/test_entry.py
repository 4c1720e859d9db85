"""The entry points in a copy of the repository without the optional folders."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from terraframe.plans.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [["terraframe/llm", "tests/llm"], ["terraframe/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_without_the_text_operators(tmp_path, gone):
    copy = tmp_path / "copy"
    left_out = {str(ROOT / g) for g in gone} | {str(ROOT / ".git")}
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if f"{d}/{n}" in left_out or n == "__pycache__"])
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    ran = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    assert ran.stdout.split() == sorted(QUERIES)
