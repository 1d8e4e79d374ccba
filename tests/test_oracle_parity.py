"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver's gate runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from lakemart.plans import catalog, catalog_feeds, catalog_tables
from tests.conftest import SF
from tools.check_oracle import TABLES, key, norm

NAMES = sorted({**catalog.QUERIES, **catalog_tables.QUERIES, **catalog_feeds.QUERIES})


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = df.columns
    got = df.collect()
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(got) == len(want)
    order = sorted(cols)
    a = sorted((tuple(norm(r[cols.index(c)]) for c in order) for r in got), key=key)
    b = sorted((tuple(norm(r[dcols.index(c)]) for c in order) for r in want), key=key)
    assert a == b
