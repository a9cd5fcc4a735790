"""The queries of this subpackage against their SQL, and that they run."""

import compare
import pytest
from conftest import SF

from loomgraph.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, con, name):
    cols, got = compare.rows_of_spark(Q.QUERIES[name](spark, SF))
    if name in Q.ORACLES:
        want_cols, want = compare.rows_of_sql(con, Q.ORACLES[name])
        assert cols == want_cols and got == want


def test_registered():
    import __spark_entry__

    assert set(Q.QUERIES) <= set(__spark_entry__.queries())
