"""The rest of the library stands without the corpus operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_corpus_operators(tmp_path):
    import shutil

    for name in ("riskspark", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') or n == 'pipeline']; print(len(q))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr


def test_nothing_imports_the_corpus_operators():
    files = [p for p in (ROOT / "riskspark").rglob("*.py") if "llm" not in p.relative_to(ROOT).parts]
    assert files and not [p for p in files if "riskspark.llm" in p.read_text(encoding="utf-8") or "from .llm" in p.read_text(encoding="utf-8")]


def test_no_local_checkpoints():
    assert not [p for p in (ROOT / "riskspark").rglob("*.py") if "localCheckpoint" in p.read_text(encoding="utf-8")]
