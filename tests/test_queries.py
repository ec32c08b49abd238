"""Every query with SQL against DuckDB on the same tables."""

import pytest

from bunchflow.plans.queries import ORACLES, QUERIES
from tests.conftest import rows_of


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
