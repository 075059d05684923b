"""J-11, R-3 from mergeable state, and M-6, K-6 with withdrawn rejects: any split of the rows, replays included, gives
the tables of one batch."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from studylake import constants as C
from studylake.operators import facts
from studylake.operators.aggregate import affected_hours, hour_partials, merged_hours, partials_before
from studylake.operators.normalise import accepted, normalise
from studylake.plans.jobs import ZonePaths, init_warehouse, load_facts, run_batch
from studylake.sinks import warehouse
from tests.fixtures import event, raw_df, sensor, small_dims


def readings(n: int = 60) -> list[dict]:
    rng = random.Random(5)
    out = []
    for i in range(n):
        hour = f"2024-01-{rng.choice(['05', '06', '31'])}T{rng.randrange(8, 11):02d}:{i % 60:02d}:00+0000"
        out.append(sensor(rng.choice([C.HEART_RATE, C.HEART_RATE, C.GYRO]), hour, subject=rng.choice(["S1", "S2", "S9", None]),
                          hb=rng.choice([None, None, 60.0 + i])))
    out += [event(C.MIGRAINE, "2024-01-05T09:00:00+0000", severity="x"), event(C.MEAL, "2024-01-05T09:00:00+0000", subject="S9")]
    return out


def refined(spark, rows):
    return accepted(normalise(raw_df(spark, rows)))


def tables(spark, root: str) -> list:
    facts_ = [tuple(r) for r in warehouse.read_table(spark, root, "f_passive").select(*C.PASSIVE_KEYS, F.round("agg_value", 9)).collect()]
    return [sorted(facts_), *[sorted(map(str, warehouse.read_table(spark, root, t).collect())) for t in ("f_intentional", "rejects", "temp_allocation_error_records")]]


def load(spark, root: str, parts: list[tuple[str, list[dict]]]) -> list:
    init_warehouse(spark, root, small_dims(spark))
    run = warehouse.RunRejects(spark, root, "run").begin()
    for tag, rows in parts:
        load_facts(spark, refined(spark, rows), None, small_dims(spark), root, run=run, batch_tag=tag)
    run.complete()
    return tables(spark, root)


def test_a_split_run_that_breaks_off_at_every_table_gives_the_tables_of_one_batch(spark, tmp_dir, monkeypatch):
    rows = readings()
    want = load(spark, f"{tmp_dir}/one", [("0", rows)])
    assert any("no_measurement" in r for r in want[2])  # some hours stay without a measurement
    rng = random.Random(1)
    place = [rng.randrange(2) for _ in rows]
    first, second = ([r for r, p in zip(rows, place, strict=True) if p == k] for k in range(2))
    root = f"{tmp_dir}/split"
    init_warehouse(spark, root, small_dims(spark))
    run = warehouse.RunRejects(spark, root, "run").begin()
    one = lambda tag, part: load_facts(spark, refined(spark, part), None, small_dims(spark), root, run=run, batch_tag=tag)
    one("0", first)
    for step in ["append_events", "upsert_passive", "add_state", "overwrite_table"]:
        real = getattr(warehouse, step)

        def broken(*a, _real=real, **kw):
            _real(*a, **kw)
            raise OSError("driver lost")

        monkeypatch.setattr(warehouse, step, broken)
        with pytest.raises(OSError):
            one("1", second)
        monkeypatch.setattr(warehouse, step, real)
    one("1", second)
    run.complete()
    assert tables(spark, root) == want


def test_a_filled_hour_is_withdrawn_and_a_later_run_starts_anew(spark, tmp_dir):
    empty, filled = [sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000")], [sensor(C.HEART_RATE, "2024-01-05T10:30:00+0000", hb=70.0)]
    init_warehouse(spark, tmp_dir, small_dims(spark))
    run = warehouse.RunRejects(spark, tmp_dir, "run").begin()
    seen = []
    for tag, rows in (("0", empty), ("1", filled), ("1", filled)):
        load_facts(spark, refined(spark, rows), None, small_dims(spark), tmp_dir, run=run, batch_tag=tag)
        seen.append([(r.reject_reason, r.reccount, r.source_records) for r in warehouse.read_table(spark, tmp_dir, "rejects").collect()])
    assert seen == [[("no_measurement", 1, 1)], [], []]
    assert [r.agg_value for r in warehouse.read_table(spark, tmp_dir, "f_passive").collect()] == [70.0]


def test_state_equals_the_history_it_stands_for(spark):
    ref = refined(spark, readings(120)).withColumn("part", F.pmod(F.xxhash64(C.MEASUREMENT_TIME, C.SUBJECT_ID), F.lit(3))).cache()
    delta, rest = ref.filter("part = 0").drop("part"), ref.filter("part > 0")
    state = hour_partials(rest.filter("part = 1").drop("part")).unionByName(hour_partials(rest.filter("part = 2").drop("part")))
    show = lambda df: sorted(str(tuple(r)) for r in df.withColumn("mean_hr", F.round("mean_hr", 9)).collect())
    want = show(affected_hours(delta, ref.drop("part")))
    assert show(merged_hours(delta, state)) == want
    assert show(merged_hours(delta, partials_before(ref.drop("part"), delta))) == want
    ref.unpersist()


def test_the_history_is_not_scanned_by_a_load(spark, tmp_dir, monkeypatch):
    """The second load's plan reads the state of the batch's days and no refine file."""
    zones, root = ZonePaths(f"{tmp_dir}/refine", f"{tmp_dir}/conform"), f"{tmp_dir}/wh"
    init_warehouse(spark, root, small_dims(spark))
    run_batch(spark, raw_df(spark, readings()), zones, small_dims(spark), root, batch_tag="a")
    seen = []
    real = facts.resolve_passive
    monkeypatch.setattr(facts, "resolve_passive", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    run_batch(spark, raw_df(spark, [sensor(C.HEART_RATE, "2024-01-05T08:59:00+0000", hb=61.0)]), zones, small_dims(spark), root, batch_tag="b")
    files = seen[0].inputFiles()
    assert any("/hour_state/" in f for f in files) and not any("/refine/" in f for f in files)
    assert {f.split("/")[-2] for f in files if "/hour_state/" in f} == {"state_date=2024-01-05"}


def test_a_zone_that_is_older_than_the_warehouse_goes_into_the_state(spark, tmp_dir):
    from studylake.sinks.zones import write_refine
    zones, root = ZonePaths(f"{tmp_dir}/refine", f"{tmp_dir}/conform"), f"{tmp_dir}/wh"
    write_refine(refined(spark, [sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000", hb=60.0)]), zones.refine, "old")
    init_warehouse(spark, root, small_dims(spark))
    run_batch(spark, raw_df(spark, [sensor(C.HEART_RATE, "2024-01-05T10:30:00+0000", hb=70.0)]), zones, small_dims(spark), root, batch_tag="new")
    assert [r.agg_value for r in warehouse.read_table(spark, root, "f_passive").collect()] == [65.0]
