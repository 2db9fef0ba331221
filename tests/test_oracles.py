"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from cadence import catalog
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(rows):
    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return v
    return sorted((tuple(cell(x) for x in r) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["coin_id", "avg_daily_return", "avg_volatility", "avg_price_brl"]


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    # plan shape: no pairs within groups, no Python evaluation
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert bad not in plan, bad
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(cols) == sorted(rel.columns)
    order = sorted(cols)
    orows = rel.fetchall()
    a = _norm([tuple(r[cols.index(c)] for c in order) for r in srows])
    b = _norm([tuple(r[rel.columns.index(c)] for c in order) for r in orows])
    assert a == b
