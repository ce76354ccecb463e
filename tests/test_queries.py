"""Every registered query against its SQL on the smallest test data."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from check_oracles import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
# A whole run of all layers has a test of its own.
NAMES = [n for n in QUERIES if n != "u04_full_run"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    problem = compare(spark, duck, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert problem in (None, "both sides empty")


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
