"""The entry module without the training-data subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_without_the_subpackage(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    shutil.rmtree(copy / "graphloom" / "llm", ignore_errors=True)
    shutil.rmtree(copy / "tests" / "llm", ignore_errors=True)
    asked = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and 'chunk_rollup' in q and not any(k.startswith('op') or k == 'pipeline' for k in q)"
    for extra in ("", "corpus_pipeline.py"):
        if extra:
            (copy / extra).unlink()
        done = subprocess.run([sys.executable, "-c", asked], cwd=copy, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
