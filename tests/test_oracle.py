"""Every registered query against its SQL oracle, or at least run to the end."""

import pytest

import __spark_entry__ as registry
from tests.compare import connect, difference
from tests.conftest import SMALL

ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SMALL)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.collect()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() == 10
