"""The engine does not lean on the training-data subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_the_training_data_subpackage():
    for path in (ROOT / "brindle").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "brindle.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path


def queries_of(folder, before=""):
    code = f"{before}\nimport __spark_entry__ as e; print(*e.queries())"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True).stdout.split()


def test_entry_works_without_it(tmp_path):
    shutil.copytree(ROOT / "brindle", tmp_path / "brindle", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    assert "pricing_summary" in queries_of(tmp_path) and "pipeline" not in queries_of(tmp_path)


@pytest.mark.parametrize("name", ["regex", "xxhash", "public_tokenizers"])
def test_entry_works_without_what_the_subpackage_needs(name):
    found = queries_of(ROOT, f"import sys; sys.modules[{name!r}] = None")
    assert "pricing_summary" in found
    assert not any(q.startswith("op") and q[2].isdigit() for q in found)
