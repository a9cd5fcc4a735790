"""Every core query against its SQL on the smallest tables."""

import compare
import pytest
from conftest import SF

from loomgraph.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    cols, got = compare.rows_of_spark(QUERIES[name](spark, SF))
    if name in SQL:
        want_cols, want = compare.rows_of_sql(con, SQL[name])
        assert cols == want_cols
        assert got == want


def test_sql_only_for_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
