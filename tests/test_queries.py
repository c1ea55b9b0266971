"""Every registered query against its SQL in DuckDB, on the smallest test set."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_contract():
    """Only queries of the optional part, which have tests of their own, may lack SQL."""
    own = {name for m in entry.MODULES if m.__name__.startswith("driver_queries.") for name in m.QUERIES}
    assert len(own) >= 65 and own <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query(spark, con, name):
    assert compare(spark, con, SF, name).startswith("ok")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
