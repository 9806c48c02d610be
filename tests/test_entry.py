"""The driver contract with and without the corpus operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from yearpanel.plans.catalog import QUERIES

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def loaded(folder):
    return subprocess.run(
        [sys.executable, "-B", "-c", COUNT], cwd=folder, capture_output=True, text=True, env={"PATH": ""}
    )


@pytest.fixture
def copy(tmp_path):
    folder = tmp_path / "repo"
    shutil.copytree(
        ROOT / "yearpanel", folder / "yearpanel", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    shutil.copy(ROOT / "__spark_entry__.py", folder)
    return folder


def test_the_contract_without_the_corpus_operators(copy):
    assert loaded(copy).stdout.split() == [str(len(QUERIES))] * 2
    (copy / "yearpanel" / "llm" / "__pycache__").mkdir(parents=True)  # what a deletion may leave
    assert loaded(copy).stdout.split() == [str(len(QUERIES))] * 2


def test_the_contract_with_the_pipeline_left_behind(copy):
    shutil.copy(ROOT / "corpus_pipeline.py", copy)
    assert loaded(copy).stdout.split() == [str(len(QUERIES))] * 2
    (copy / "yearpanel" / "llm" / "__pycache__").mkdir(parents=True)
    assert loaded(copy).stdout.split() == [str(len(QUERIES))] * 2


def test_an_error_in_the_corpus_operators_is_not_hidden(copy):
    (copy / "yearpanel" / "llm").mkdir()
    (copy / "yearpanel" / "llm" / "__init__.py").touch()
    (copy / "yearpanel" / "llm" / "catalog.py").write_text("import no_such_module\n")
    found = loaded(copy)
    assert found.returncode and "no_such_module" in found.stderr
