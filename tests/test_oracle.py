"""Every registered query against its DuckDB twin at sf0.01 (the driver's
correctness gate)."""

import pytest

from rewardloom.plans import ORACLE, QUERIES
from tests.conftest import SF01

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    from tools.oracle_check import compare
    res = compare(spark, name, SF01, duck)
    assert res["status"] == "match", res


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck_small():
    from tools.oracle_check import connect
    from tests.conftest import SF001
    return connect(SF001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle_smallest(spark, duck_small, name):
    """The same twins on the smoke-check input (sf0.001)."""
    from tools.oracle_check import compare
    from tests.conftest import SF001
    res = compare(spark, name, SF001, duck_small)
    assert res["status"] == "match", res
