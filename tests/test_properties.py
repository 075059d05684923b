"""Properties of the load on the sf0.001 adapter data."""

from __future__ import annotations

from pyspark.sql import functions as F

from studylake import constants as C
from studylake.operators import facts
from studylake.operators.normalise import accepted, normalise, rejected
from studylake.plans.jobs import ZonePaths, init_warehouse, run_batch
from studylake.sinks import warehouse
from studylake.sinks.zones import write_conform, write_refine
from studylake.sources import adapter
from studylake.sources.zones import read_conform, read_refine
from tests.conftest import SF0001


def _fact_rows(df):
    return sorted(tuple(r) for r in df.select(*C.PASSIVE_KEYS, F.round("agg_value", 6)).collect())


def test_accepted_plus_rejected_is_input(spark):
    raw = adapter.study_raw(spark, SF0001)
    dims = adapter.study_dims(spark, SF0001)
    n = normalise(raw)
    assert accepted(n).count() + rejected(n).count() == raw.count()
    ref = accepted(n)
    ev = facts.resolve_events(ref, dims)
    assert facts.event_fact(ev).count() + ev.filter("reject_reason is not null").count() == \
        ref.filter(F.col(C.TYPE_P).isin(*C.EVENT_TYPES)).count()
    pv = facts.resolve_passive(ref, dims)
    assert pv.agg(F.sum("rec_count")).first()[0] == ref.filter(~F.col(C.TYPE_P).isin(*C.EVENT_TYPES)).count()


def test_refine_and_conform_hold_the_same_rows(spark, tmp_dir):
    ref = accepted(normalise(adapter.study_raw(spark, SF0001)))
    write_refine(ref, f"{tmp_dir}/r")
    write_conform(ref, f"{tmp_dir}/c")
    cols = [C.DATA_TYPE, C.SUBJECT_ID, C.MEASUREMENT_TIME, C.START_TIME, C.HEART_BEAT, C.X_ACC, C.X_GYRO]
    r = read_refine(spark, f"{tmp_dir}/r").select(*cols)
    c = read_conform(spark, f"{tmp_dir}/c").select(*cols)
    assert r.count() == c.count() == ref.count()
    assert r.exceptAll(c).count() == 0 and c.exceptAll(r).count() == 0


def _load(spark, base, batches, dims):
    zones = ZonePaths(refine=f"{base}/refine", conform=f"{base}/conform")
    root = f"{base}/wh"
    init_warehouse(spark, root, dims)
    for b in batches:
        run_batch(spark, b, zones, dims, root)
    return warehouse.read_table(spark, root, "f_passive"), warehouse.read_table(spark, root, "f_intentional")


def test_split_batches_and_replays_give_the_same_facts(spark, tmp_dir):
    raw = adapter.study_raw(spark, SF0001).cache()
    dims = adapter.study_dims(spark, SF0001)
    one_p, one_e = _load(spark, f"{tmp_dir}/one", [raw], dims)
    # Split by an arbitrary column (the text of the subject), so hours are split across batches.
    a = raw.filter(F.col(C.SUBJECT_ID) < "S5")
    b = raw.filter(~(F.col(C.SUBJECT_ID) < "S5"))
    two_p, two_e = _load(spark, f"{tmp_dir}/two", [a, b, a], dims)  # the last one is a replay
    assert _fact_rows(one_p) == _fact_rows(two_p)
    assert one_e.count() == two_e.count()
    expected = facts.passive_fact(facts.resolve_passive(accepted(normalise(raw)), dims))
    assert _fact_rows(one_p) == _fact_rows(expected)


def test_replayed_tagged_batch_does_not_double_history(spark, tmp_dir):
    """A micro-batch replayed with the same tag replaces its zone files, so hourly means that
    span batches stay right (an untagged append would count the replayed readings twice)."""
    from studylake.sources.zones import read_refine as _read
    raw = adapter.study_raw(spark, SF0001).cache()
    dims = adapter.study_dims(spark, SF0001)
    sec = F.substring(F.coalesce(F.col(C.MEASUREMENT_TIME), F.col(C.START_TIME)), 18, 2).cast("int")
    a, b = raw.filter(sec % 2 == 0), raw.filter(sec % 2 == 1)
    zones = ZonePaths(refine=f"{tmp_dir}/refine", conform=f"{tmp_dir}/conform")
    root = f"{tmp_dir}/wh"
    init_warehouse(spark, root, dims)
    for batch, tag in [(a, "q-0"), (b, "q-1"), (a, "q-0")]:
        run_batch(spark, batch, zones, dims, root, batch_tag=tag)
    assert _read(spark, zones.refine).count() == raw.count()
    expected = facts.passive_fact(facts.resolve_passive(accepted(normalise(raw)), dims))
    assert _fact_rows(warehouse.read_table(spark, root, "f_passive")) == _fact_rows(expected)
