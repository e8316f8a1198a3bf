"""The driver's contract, with and without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["host", "items", "body_empty", "body_chars_median"] and df.count() > 0


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) >= 60


def test_without_the_subpackage(tmp_path):
    import shutil

    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; assert len(e.queries()) >= 60 and not any(q.startswith('op') or q == 'pipeline' for q in e.queries())"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "r", check=True, timeout=120)
    stale = tmp_path / "r/tessera/llm/__pycache__"
    stale.mkdir(parents=True)  # a folder that deletion left behind
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "r", check=True, timeout=120)


def test_nothing_else_imports_it():
    for p in ROOT.rglob("*.py"):
        inside = p.relative_to(ROOT).parts
        if "llm" not in inside and p.name not in ("corpus_pipeline.py", "__spark_entry__.py", "test_entry.py"):
            assert "tessera.llm" not in p.read_text() and "corpus_pipeline" not in p.read_text(), p
