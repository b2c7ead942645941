"""Every catalogue query against its DuckDB twin on the small fixtures."""

import duckdb
import pytest

import __spark_entry__ as entry
from sluice.plans import catalogue
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    q, s = catalogue.queries(), catalogue.oracle_sql()
    assert set(q) == set(s)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_duckdb(spark, con, name):
    df = catalogue.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(catalogue.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["destination", "messages", "sum_k", "max_offset", "kafka_topic"]
