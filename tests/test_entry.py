"""The entry module with and without the subpackage of training-data operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, sorted(set(e.oracle_sql()) - set(q)))"


def _asked(folder) -> list[str]:
    done = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def _copy(folder, *without: str):
    gone = shutil.ignore_patterns(".git", "__pycache__", "llm" if "llm" in without else "-", *without)
    return shutil.copytree(REPO, folder, ignore=gone)


def test_entry_imports_without_the_training_operators(tmp_path):
    plain = _asked(_copy(tmp_path / "a", "llm"))
    assert int(plain[0]) > 140 and plain[1:] == ["False", "[]"]
    assert _asked(_copy(tmp_path / "b", "llm", "corpus_pipeline.py")) == plain


def test_entry_registers_every_query_with_its_sql():
    assert _asked(REPO)[2] == "[]"
