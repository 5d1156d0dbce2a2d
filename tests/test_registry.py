"""Every registered query against its DuckDB check on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return (1, "nan") if math.isnan(f) else (1, repr(round(f, 9)))
    if isinstance(v, (dt.date, dt.datetime)):
        return (3, v.isoformat())
    return (4, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_check():
    own = set(E.queries()) - set(E.LLM_QUERIES)
    assert own == set(E.oracle_sql()) - set(E.LLM_ORACLE)
    assert set(E.LLM_ORACLE) <= set(E.LLM_QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["product_name", "price", "source"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    rows = df.collect()
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    a = sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in rows)
    idx = {c: i for i, c in enumerate(ocols)}
    b = sorted(tuple(norm(r[idx[c]]) for c in sorted(cols)) for r in orows)
    assert len(a) == len(b)
    assert a == b
