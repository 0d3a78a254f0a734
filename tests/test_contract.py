"""The contract with and without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

from postloom import oracles, registry

REPO = Path(__file__).resolve().parent.parent


def test_the_rest_works_without_the_subpackage(tmp_path):
    kept = tmp_path / "repo"
    shutil.copytree(REPO, kept, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=kept, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(registry.queries())), str(len(oracles.oracle_sql())), "False"], out.stderr


def test_nothing_else_imports_the_subpackage():
    for path in (REPO / "postloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "postloom.llm" not in path.read_text(), path
