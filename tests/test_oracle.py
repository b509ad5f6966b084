"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as registry
from compare import assert_same, duck, plan
from starqueries.oracle import ORACLE
from starqueries.spark import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    frame = QUERIES[name](spark, SF_DIR)
    text = plan(frame)
    # No cross joins, and no Python workers on the data path.
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
        assert operator not in text
    assert_same(frame, connection, ORACLE[name])


def test_entry_returns_rows(spark):
    frame = registry.entry(spark)
    assert frame.columns == ["product_id", "p_brand", "p_type", "p_size", "n_lines"]
    assert frame.agg({"n_lines": "sum"}).first()[0] == 6000
