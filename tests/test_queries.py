"""Every registered query against its SQL, and what the driver expects of the entry points."""

import pytest

import __spark_entry__ as entry_points
from graphloom.plans import check

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, connection, name):
    found = check.fingerprint(*check.spark_result(QUERIES[name](spark, SF_DIR)))
    wanted = check.fingerprint(*check.sql_result(connection, ORACLE[name]))
    assert found == wanted


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    own = {name for name in QUERIES if not name.startswith("op") and name != "pipeline"}
    assert own - set(ORACLE) == {"communities", "communities_names", "knn_descent", "knn_lsh"}


def test_entry_has_rows(spark):
    found = entry_points.entry(spark)
    assert found.columns == ["page", "similar_page", "score", "rank"]
    assert found.count() > 0
