"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import difference

QUERIES, SQL = queries(), oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    if name in SQL:
        assert difference(df, duck, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
