"""Every registered query beside its SQL twin on the smallest tables."""

import os

import pytest
from compare import compare, database

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    problem, _ = compare(spark, con, QUERIES[name], ORACLE[name], FOLDER)
    assert problem is None, problem


def test_all_are_listed(spark):
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)
    assert entry.entry(spark).columns == QUERIES["alert_rows"](spark, FOLDER).columns
