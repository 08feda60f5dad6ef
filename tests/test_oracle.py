"""Every query with SQL, against DuckDB, on the smallest driver tables."""

import pytest

import check_oracle
from catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    # Some conditions have no match at this size; equality with the SQL is the test.
    problem = check_oracle.compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert problem is None


def test_names_and_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    rows = entry.entry(spark).collect()
    assert sum(r["n_records"] for r in rows) > 0
