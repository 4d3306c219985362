"""The entry point must work without the text operators, with or without their pipeline."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from riskloom.plans.catalogue import catalogue
from riskloom.plans.oracles import oracles

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_registers_the_rest_without_text_operators(tmp_path, with_pipeline):
    shutil.copytree(ROOT / "riskloom", tmp_path / "riskloom", ignore=lambda *_: ["llm", "__pycache__"])
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    pipeline = ROOT / "corpus_pipeline.py"
    if with_pipeline and pipeline.exists():
        shutil.copy(pipeline, tmp_path)
    code = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert done.stdout.split() == [*sorted(catalogue()), "|", *sorted(oracles())]
