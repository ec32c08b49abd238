import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
# Python workers import the package too.
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

TESTDATA = Path(os.environ.get("BUNCHFLOW_TESTDATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not TESTDATA.is_dir():
        pytest.skip("no test tables")
    return str(TESTDATA)


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in Path(sf_dir).iterdir():
        at = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{at}'")
    return con


def rows_of(df):
    """Rows as sorted tuples of text, floats rounded."""
    names = sorted(df.columns)
    return sorted(tuple(str(round(x, 6) + 0.0 if isinstance(x, float) else x) for x in (r[c] for c in names)) for r in df.to_dict("records"))
