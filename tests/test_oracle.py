"""Every registered query equals its DuckDB oracle (sf0.001, order-insensitive)."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.sources.tables import TABLES

from paths import SF_SMALL

QUERIES = E.queries()
SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float) and not math.isnan(x):
            return float(f"{x:.12g}")
        return x
    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(SQLS[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), ocols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQLS)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() >= 1


def test_entry(spark):
    assert E.entry(spark).count() > 0
