"""The entry without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

TOP = Path(__file__).resolve().parent.parent
RUN = """
import __spark_entry__ as entry
from linkloom.session import build_session
names = entry.queries()
assert "q1_top_inventors" in names and not [n for n in names if n.startswith("op")], names
assert "pipeline" not in names and entry.oracle_sql().keys() <= names.keys()
spark = build_session("entry", local_cores=2)
assert names["q1_top_inventors"](spark, "/root/testdata/sf0.001").count() > 0
"""


@pytest.mark.parametrize("also", [[], ["corpus_pipeline.py"]])
def test_entry_without_the_corpus_operators(tmp_path, also):
    """With and without the pipeline's file, of which nothing may be needed."""
    left_out = shutil.ignore_patterns("__pycache__", "llm")
    shutil.copytree(TOP / "linkloom", tmp_path / "linkloom", ignore=left_out)
    for name in ("__spark_entry__.py", *also):
        if (TOP / name).exists():
            shutil.copy(TOP / name, tmp_path)
    done = subprocess.run([sys.executable, "-c", RUN], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
