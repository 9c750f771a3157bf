"""Differential: every registered query against its DuckDB oracle."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as E
from testbed import registry
from testbed.oracle import oracle_queries
from tests.conftest import SF_SMALL

KEYS = sorted(registry.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def test_every_query_has_an_oracle():
    assert set(oracle_queries()) == set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck_small, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = duck_small.sql(E.oracle_sql()[key])
    assert sorted(rel.columns) == cols
    idx = {c: i for i, c in enumerate(rel.columns)}
    want = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    # Request Q1 at sf0.001: 7 weekday hours.
    assert sum(1 for r in rows if r["request_id"] == 1) == 7
    assert df.columns[0] == "request_id"
