"""Every core query against its DuckDB oracle (the driver's check, at sf0.001)."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from studylake.catalog import QUERIES
from studylake.oracle import ORACLE
from tests.conftest import SF0001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: repr(round(v, 6)) if isinstance(v, float) else repr(v)
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_every_core_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    srows = [tuple(r) for r in df.collect()]
    r = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in r.description]
    drows = r.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "agg_value" in df.columns
