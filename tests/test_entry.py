"""The library without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as entry
names = entry.queries()
assert "rule_tags" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names), names
assert set(entry.oracle_sql()) <= set(names)
import sys
assert not any(m.startswith("doctag.llm") for m in sys.modules)
"""


def copied(tmp_path, *left_out):
    ignore = shutil.ignore_patterns(".git", "__pycache__", "*.json", *left_out)
    shutil.copytree(ROOT, tmp_path / "copy", ignore=ignore)
    return tmp_path / "copy"


def test_entry_without_the_optional_folders(tmp_path):
    """With and without the pipeline's module, which needs them."""
    folder = copied(tmp_path, "llm")
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", CODE], cwd=folder, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        (folder / "corpus_pipeline.py").unlink(missing_ok=True)
