"""The entry module without the text operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_imports_without_the_text_operators(tmp_path):
    """With the subpackage gone, and with its pipeline gone too, the other queries are all there."""
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(ROOT / "tallyguard", tmp_path / "tallyguard", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "oracle_queries.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()), 'pipeline' in e.queries())"
    for _ in range(2):
        found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
        assert found.returncode == 0, found.stderr
        number, covered, pipeline = found.stdout.split()
        assert int(number) > 100 and covered == "True" and pipeline == "False"
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
