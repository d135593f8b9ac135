"""The library without the text subpackage: the entry imports and keeps every market query."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAYS = "import __spark_entry__ as e; from gridlake.plans import registry; assert set(e.queries()) == set(registry.QUERIES) and set(e.oracle_sql()) == set(registry.ORACLE_SQL)"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_text_operators(tmp_path, pipeline):
    for name in ("gridlake", "__spark_entry__.py", "corpus_pipeline.py"):
        there = ROOT / name
        if there.is_dir():
            shutil.copytree(there, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif there.exists() and (pipeline or name != "corpus_pipeline.py"):
            shutil.copy(there, tmp_path / name)
    # What git leaves of a folder that was deleted: a package without modules.
    (tmp_path / "gridlake" / "llm" / "__pycache__").mkdir(parents=True)
    run = subprocess.run([sys.executable, "-c", SAYS], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr


def test_entry_without_tokenizer_files(tmp_path):
    hidden = "import sys; sys.modules['public_tokenizers'] = None; "
    run = subprocess.run([sys.executable, "-c", hidden + SAYS], cwd=ROOT, env=os.environ | {"PYTHONPATH": str(ROOT)}, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
