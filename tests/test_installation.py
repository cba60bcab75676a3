"""The library without its operators on training text."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROBE = """
import __spark_entry__ as entry
assert entry.__file__.startswith({root!r}), entry.__file__
names = set(entry.queries())
assert set(entry.oracle_sql()) == names and "sanitize_df" in names
assert not [n for n in names if n.startswith("op")] and "pipeline" not in names
"""


def test_entry_imports_without_the_operators_on_training_text(tmp_path):
    root = str(tmp_path / "copy")
    leave = shutil.ignore_patterns("llm", ".git", "__pycache__", "spark-warehouse")
    shutil.copytree(ROOT, root, ignore=leave)
    assert os.path.isfile(f"{root}/corpus_pipeline.py") and not os.path.exists(f"{root}/veildesk/llm")
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", PROBE.format(root=root)], cwd=root, env=clean, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
