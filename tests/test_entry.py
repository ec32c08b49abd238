"""The driver's contract, with and without the optional parts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(entry.__file__).resolve().parent


def test_entry(spark):
    if not Path("/root/testdata/sf0.001").is_dir():
        pytest.skip("no test tables")
    df = entry.entry(spark)
    assert df.columns == ["event", "i1", "i2", "i3", "pt_sum", "mass"] and df.count() > 0


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("pipeline", [False, True])
def test_without_the_optional_parts(tmp_path, pipeline):
    """A copy without them imports and keeps the other queries, with the pipeline's own file or not."""
    shutil.copytree(ROOT / "bunchflow", tmp_path / "bunchflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; print(sorted(k for k in e.queries() if k.startswith('op') or k == 'pipeline'), len(e.queries()) > 60)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.stdout.split("\n")[0] == "[] True", done.stderr
