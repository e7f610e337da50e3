"""The entry module without the optional subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; print(len(e.queries()), sorted(n for n in e.queries() if n[:2] == 'op' and n[2].isdigit() or n == 'pipeline'))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_the_training_data_subpackage(tmp_path, with_pipeline):
    for folder in ("wattloom", "catalog"):
        shutil.copytree(REPO / folder, tmp_path / folder, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    names = ["__spark_entry__.py"] + ["corpus_pipeline.py"] * (with_pipeline and (REPO / "corpus_pipeline.py").exists())
    for name in names:
        shutil.copy(REPO / name, tmp_path / name)
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, left = done.stdout.split(" ", 1)
    assert int(count) > 100 and left.strip() == "[]"
