"""The registered queries must be there with and without the folders of the training-data operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_imports_without_training_operators(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "stratum", copy / "stratum", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *["corpus_pipeline.py"] * with_pipeline]:
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, copy / name)
    code = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); assert set(o) <= set(q); print(len(q), 'pipeline' in q)"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    count, pipeline = run.stdout.split()
    assert int(count) >= 30 and pipeline == "False"
