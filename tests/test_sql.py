"""Every registered query gives the rows of its SQL, and the entry works without the optional part."""

import os
import shutil
import subprocess
import sys

import pytest
from compare import TESTDATA, difference

import __spark_entry__ as entry
import checks

SIZES = [size for size in os.environ.get("SPEECHLAKE_SF", "sf0.001 sf0.01").split() if os.path.isdir(os.path.join(TESTDATA, size))]
QUERIES, SQL = entry.queries(), checks.SQL


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query(spark, name, size):
    assert difference(QUERIES[name], SQL[name], spark, os.path.join(TESTDATA, size)) is None


@pytest.mark.skipif(not SIZES, reason="no test data")
def test_entry(spark):
    assert entry.entry(spark).columns == ["corpus", "language", "hours"]


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_optional_part(tmp_path, pipeline):
    """A copy without the training-data operators (and their pipeline) registers all the other queries."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    gone = ["llm", ".git", "__pycache__"] + ([] if pipeline else ["corpus_pipeline.py"])
    copy = shutil.copytree(root, tmp_path / "copy", ignore=shutil.ignore_patterns(*gone))
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert said.stdout.split() == sorted(checks.QUERIES)
