"""The library without its optional packages."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; print(sorted(n for n in e.queries() if n == 'pipeline' or n[:2] == 'op'), len(e.oracle_sql()) > 100)"


@pytest.mark.parametrize("pipeline_too", [False, True])
def test_imports_without_optional_packages(tmp_path, pipeline_too):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *(["corpus_pipeline.py"] if pipeline_too else []))
    shutil.copytree(ROOT, copy, ignore=left_out)
    said = subprocess.run([sys.executable, "-c", SAY], cwd=copy, capture_output=True, text=True, check=True)
    assert said.stdout.split("\n")[0] == "[] True"
