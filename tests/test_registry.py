"""Every registered query against its DuckDB statement (sf0.001), and the
rows-only keys for a clean run."""

import os

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E
from starfold.sources.tables import DRIVER_TABLES
from tools.compare import rows_of

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_key_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 69


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_runs(spark, key):
    assert QUERIES[key](spark, SF_SMALL).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "region", "channel", "category", "total_orders", "total_units",
                          "total_revenue", "avg_order_value"]
