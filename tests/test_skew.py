"""A hot subject holding over a third of all rows: results still match the oracle."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from studylake.session import scratch_path
from tests.conftest import SF0001
from tests.test_oracle import _digest

HOT_USER = 3
COPIES = 12


@pytest.fixture(scope="module")
def skewed_dir(spark):
    d = scratch_path(spark, "skewed")
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    hot = ev.filter(F.col("user_id") == HOT_USER)
    extra = hot.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(COPIES)))).select(
        (F.col("event_id") + F.col("k") * 1_000_000).alias("event_id"),
        F.timestamp_add("SECOND", F.col("k"), F.col("ts")).alias("ts"),
        "user_id", "event_type", (F.col("value") + F.col("k")).alias("value"), "props")
    ev.unionByName(extra).write.parquet(f"{d}/events.parquet")
    for t in ("customer", "supplier", "nation"):
        spark.read.parquet(f"{SF0001}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    total = spark.read.parquet(f"{d}/events.parquet")
    assert total.filter(F.col("user_id") == HOT_USER).count() * 3 > total.count()
    return d


@pytest.mark.parametrize("name", ["passive_fact", "event_fact", "reject_summary", "affected_hours", "group_counts"])
def test_hot_subject_matches_oracle(spark, skewed_dir, name):
    con = duckdb.connect()
    local = skewed_dir[len("file:"):] if skewed_dir.startswith("file:") else skewed_dir
    for t in ("events", "customer", "supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{local}/{t}.parquet/*.parquet')")
    df = E.queries()[name](spark, skewed_dir)
    r = con.execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in r.description], r.fetchall()
    srows = [tuple(x) for x in df.collect()]
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_hot_subject_with_shuffle_joins_matches_oracle(spark, skewed_dir):
    """The same skewed data with every dimension over the broadcast bound (shuffle-join path)."""
    from studylake.catalog import _event_out, _passive_out
    from studylake.operators import facts
    from studylake.operators.normalise import accepted, normalise
    from studylake.sources import adapter

    con = duckdb.connect()
    local = skewed_dir[len("file:"):] if skewed_dir.startswith("file:") else skewed_dir
    for t in ("events", "customer", "supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{local}/{t}.parquet/*.parquet')")
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        dims = adapter.study_dims(spark, skewed_dir)
        dims.max_broadcast_rows = 1
        ref = accepted(normalise(adapter.study_raw(spark, skewed_dir)))
        got = {"passive_fact": _passive_out(facts.passive_fact(facts.resolve_passive(ref, dims))),
               "event_fact": _event_out(facts.event_fact(facts.resolve_events(ref, dims)))}
        for name, df in got.items():
            r = con.execute(E.oracle_sql()[name])
            dcols, drows = [d[0] for d in r.description], r.fetchall()
            srows = [tuple(x) for x in df.collect()]
            assert len(srows) == len(drows), name
            assert _digest(df.columns, srows) == _digest(dcols, drows), name
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
