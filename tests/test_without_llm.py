"""Without the llm folders the entry point still gives every other query."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_point_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda at, names: [n for n in names if n in ("llm", ".git", "__pycache__", ".pytest_cache", "spark-warehouse")])
    code = ("import __spark_entry__ as e; from blotter.plans.catalog import QUERIES; "
            "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql()); import bench, blotter.__main__; print('fine')")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip().endswith("fine"), out.stderr
    assert (copy / "corpus_pipeline.py").exists() and not (copy / "blotter" / "llm").exists()


def test_nothing_else_imports_the_llm_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "blotter")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    text = open(os.path.join(folder, n)).read()
                    assert "blotter.llm" not in text and "from .llm" not in text and "from ..llm" not in text, n
