"""Every registered query: equal to its SQL twin, or at least well formed."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

ALL, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(base):
    return connect(base)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, base, con, name):
    assert difference(ALL[name](spark, base), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_has_rows(spark, base, name):
    rows = ALL[name](spark, base).collect()
    assert rows
    for row in rows:
        for value in row:
            assert value == value, "NaN in result"


def test_every_sql_has_a_query():
    assert set(SQL) <= set(ALL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["region", "grade", "out_prncp"]
    assert df.select("region").distinct().count() == 4
