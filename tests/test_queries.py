"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__
from chronotable import workloads
from chronotable.workloads import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_entry(spark):
    rows = {r.status: r.row_count for r in __spark_entry__.entry(spark).collect()}
    assert set(rows) == {2, 3, 4, 5}
    assert rows[2] == rows[4]


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert compare(spark, connection, QUERIES[name], SQL[name], SF) == []


@pytest.mark.parametrize("name", workloads._OPEN_ENDS)
def test_open_ends_are_timestamps(spark, connection, name):
    """The registered queries show them as text; here the timestamps themselves are compared."""
    query = next(m.QUERIES[name] for m in workloads._MODULES if name in m.QUERIES)
    sql = next(m.SQL[name] for m in workloads._MODULES if name in m.SQL)
    df = query(spark, SF)
    assert {dict(df.dtypes)[c] for c in workloads._OPEN_ENDS[name]} == {"timestamp_ntz"}
    assert compare(spark, connection, lambda *_: df, sql, SF) == []
