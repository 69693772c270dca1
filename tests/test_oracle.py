"""Every registered query against its independent DuckDB oracle (row count, names, order-free value hash)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, digest
from tripmart.plans.catalog import QUERIES

from .conftest import SF_SMALL

KEYS = sorted(QUERIES)  # the queries of the training-data subpackage have tests of their own
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_key_has_an_oracle():
    assert set(ORACLE) == set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sp = E.queries()[key](spark, SF_SMALL).toPandas()
    dd = con.sql(ORACLE[key]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert digest(sp) == digest(dd)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_trips" in df.columns
