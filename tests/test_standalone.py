"""The library without the training-data folder, with and without the pipeline file."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_imports_without_the_folder(tmp_path, pipeline_stays):
    copy = tmp_path / "copy"
    leave = shutil.ignore_patterns(".git", "__pycache__", "llm", *([] if pipeline_stays else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=leave)
    code = ("import __spark_entry__ as se; q = se.queries(); assert set(se.oracle_sql()) <= set(q) and len(q) > 80; "
            "assert 'pipeline' not in q and not [k for k in q if k[:2] == 'op' and k[2:3].isdigit()]")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
