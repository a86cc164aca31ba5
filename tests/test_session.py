"""The shared working folder."""

import os
import subprocess
import sys

from conftest import ROOT

CODE = """
import sys
sys.path.insert(0, {root!r})
from blotter.session import build_session, materialize
spark = build_session("local[1]", 1, "leaves-nothing", {{"spark.checkpoint.dir": {base!r}}})
print(materialize(spark.range(5), "numbers").count())
print(len(__import__("os").listdir({base!r} + "/blotter")))
{end}
"""


def run(base, end):
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, base=str(base), end=end)], capture_output=True, text=True, timeout=120, cwd=base)
    assert out.stdout.split() == ["5", "1"], out.stderr
    return os.listdir(base / "blotter")


def test_working_folders_are_deleted_when_the_driver_ends(tmp_path):
    assert run(tmp_path, "") == []


def test_also_after_the_session_was_stopped(tmp_path):
    assert run(tmp_path, "spark.stop()") == []
