"""Every registered query against its SQL text, on the smallest tables."""

import pytest
from compare import connect, differences

from claimloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()
QUERIES = catalog.queries()
# Their results are checked in test_audit and test_fields instead.
WITHOUT_SQL = {"s05_record_hash64", "o06_audit_report"}


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_all_but_two_have_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, db, name):
    assert differences(QUERIES[name](spark, FOLDER), db, SQL[name]) is None


def test_compare_sees_differences(spark, db):
    one = spark.createDataFrame([(1, 2.5)], "a int, b double")
    assert differences(one, db, "SELECT 1 AS a, 2.5 AS b") is None
    assert differences(one, db, "SELECT 1 AS a, 2.25 AS b") is not None
    assert differences(one, db, "SELECT 1 AS a, 2.5 AS c") is not None
    assert differences(one, db, "SELECT 1 AS a, 2.5 AS b WHERE FALSE") is not None
