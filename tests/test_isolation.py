"""The library without its training-data subpackage: it imports, registers its queries and collects its tests."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LEFT_OUT = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", "*.json", "*.txt", "*.md")
COUNT = "import __spark_entry__ as e; print(sorted(n for n in e.queries() if n.startswith('op') or n == 'pipeline'), len(e.queries()) == len(e.oracle_sql()))"


def _run(folder: Path, *args: str) -> str:
    done = subprocess.run([sys.executable, *args], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stdout + done.stderr
    return done.stdout


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_and_collects_without_the_subpackage(tmp_path, pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=LEFT_OUT)
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink()
    assert not (copy / "quadra" / "llm").exists() and not (copy / "tests" / "llm").exists()
    assert _run(copy, "-c", COUNT).split() == ["[]", "True"]
    assert "error" not in _run(copy, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider").lower().rsplit("\n", 3)[-2]


def test_an_empty_folder_of_the_subpackage_counts_as_absent(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=LEFT_OUT)
    (copy / "quadra" / "llm" / "__pycache__").mkdir(parents=True)
    assert _run(copy, "-c", COUNT).split() == ["[]", "True"]
