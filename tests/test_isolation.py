"""The library without the optional subpackage for training text and its pipeline."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_works_without_the_optional_parts(tmp_path):
    keep = shutil.ignore_patterns("llm", "__pycache__", "corpus_pipeline.py")
    shutil.copytree(os.path.join(ROOT, "tabqual"), tmp_path / "tabqual", ignore=keep)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert len(q) > 50 and set(o) <= set(q) and not any(n.startswith('op') or n == 'pipeline' for n in q)")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
