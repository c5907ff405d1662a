"""Every registered query against its DuckDB oracle (sf0.001) and the driver contract."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from tools.check_oracle import TABLES, digest

from orderflow.plans import catalog
from orderflow.streaming import twins

# the optional training-data queries have their own tests
OWN = {*catalog.QUERIES, *twins.STREAM_QUERIES}
QUERIES = {n: f for n, f in E.queries().items() if n in OWN}
SQL = {n: q for n, q in E.oracle_sql().items() if n in OWN}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "customerId", "state", "product", "quantity", "price"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF001).toPandas()
    exp = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert digest(got) == digest(exp)
