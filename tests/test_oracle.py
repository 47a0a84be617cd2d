"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF01

# The operators of the llm subpackage have their own tests.
QUERIES = {k: f for k, f in E.queries().items() if k not in E.LLM_QUERIES}
ORACLES = {k: s for k, s in E.oracle_sql().items() if k not in E.LLM_ORACLES}


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _canon(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(SF01, name)}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_some_looked_up_titles_are_null(spark):
    titles = [r["Title"] for r in QUERIES["title_lookup_left"](spark, SF01).collect()]
    assert None in titles and any(titles)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF01)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[key])
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert _canon(got, df.columns) == _canon(want, want_cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Title", "cnt"]
    assert 0 < df.count() <= 10
