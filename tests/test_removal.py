"""The engine without the corpus subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_imports_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT / "tidemill", copy / "tidemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and not any(n.startswith('op') for n in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for file in (ROOT / "tidemill").rglob("*.py"):
        if "llm" not in file.parts:
            assert "tidemill.llm" not in file.read_text(encoding="utf-8"), file
