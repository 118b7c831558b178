"""Every registered query equals its DuckDB oracle (as a bag of rows) on sf0.001."""

import math

import pytest

import __spark_entry__ as E
from parley.plans.oracle import ORACLE
from parley.plans.queries import QUERIES

from conftest import SF_SMALL

KEYS = sorted(QUERIES)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["n_total"] == 19 and rows[0]["n_key"] == 2
