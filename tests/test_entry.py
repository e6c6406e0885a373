"""The entry module without the folders of the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [["siltstone/llm"], ["siltstone/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_imports_without(tmp_path, gone):
    skipped = shutil.ignore_patterns(".git", "__pycache__", "tests", *(Path(g).name for g in gone))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skipped)
    code = "import __spark_entry__ as e; q = set(e.queries()); assert set(e.oracle_sql()) <= q; print(*sorted(q))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split()
    assert "gold_report" in names
    assert not [n for n in names if n == "pipeline" or n.startswith("op")]
