"""Every registered query equals its DuckDB oracle on the sf0.01 tables; entry() smoke."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from candleframe.plans.oracle import oracle_sql
from candleframe.plans.queries import queries
from conftest import SF001, SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(v):
    # Exact: both sides already round to 6 decimals with the same binary rule.
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    return v


def _key(t):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF001)
    cols = sorted(df.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = duck.execute(oracle_sql()[key])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert len(srows) == len(drows)
    assert srows == drows


def test_every_query_has_sql_and_is_registered():
    assert set(oracle_sql()) == set(queries()) <= set(entry.queries())
    assert set(oracle_sql()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["base_currency", "quote_currency", "year", "classification", "annual_volatility", "n_days"]
    assert df.count() >= 0


def test_queries_run_at_smallest_scale(spark):
    for key, q in queries().items():
        q(spark, SF0001).count()
