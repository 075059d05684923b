"""P-11, S-1 (unknown fields), D-6, C-3 (rejected rows and their replay), S-4 (admission by bytes)."""

from __future__ import annotations

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas
from studylake.operators.normalise import accepted, normalise
from studylake.plans.jobs import ZonePaths, init_warehouse, replay_quarantine, run_batch
from studylake.sinks import warehouse
from studylake.sinks.zones import write_conform, write_refine
from studylake.sources.promoted import promote, promoted_fields, with_promoted
from studylake.sources.raw import read_raw
from studylake.sources.zones import backlog, read_conform, read_refine
from studylake.streaming.incremental import run_incremental_facts
from tests.fixtures import event, raw_df, sensor, small_dims


def write_lines(folder: str, lines: list[str], name: str = "a.json") -> None:
    folder = folder.removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_unknown_fields_survive_both_zones_and_are_promoted_without_raw(spark, tmp_dir):
    known = {C.DATA_TYPE: "gyro", C.SUBJECT_ID: "S1", C.STUDY_TYPE: "meal_study", C.MEASUREMENT_TIME: "2024-01-05T10:20:00+0000", C.X_GYRO: 1.5}
    lines = [json.dumps(known | {"battery": 87, "place": {"lat": 1.5, "tags": ["a"]}, "note": "é"}),
             json.dumps(known | {"battery": "full"}), json.dumps(known), "", "{broken", json.dumps(known | {C.X_GYRO: "not a number", "battery": 5})]
    write_lines(f"{tmp_dir}/raw/y=2024/m=1", lines)
    raw = read_raw(spark, f"{tmp_dir}/raw/*/*")
    assert [r.n for r in raw.groupBy(C.SOURCE_FILE).agg(F.count("*").alias("n")).collect()] == [5]  # a blank line is no record
    n = normalise(raw)
    assert sorted(r.reject_reason or "" for r in n.collect()) == ["", "", "", "corrupt_record", "corrupt_record"]
    ref = accepted(n)
    write_refine(ref, f"{tmp_dir}/r")
    write_conform(ref, f"{tmp_dir}/c")
    for read, zone in ((read_refine, f"{tmp_dir}/r"), (read_conform, f"{tmp_dir}/c")):
        rest = [r.rest for r in read(spark, zone).collect()]
        assert sorted(sorted(r) for r in rest if r) == [["battery"], ["battery", "note", "place"]] and None in rest
        promote(spark, zone, "battery", "double")
        promote(spark, zone, "battery", "int")
        promote(spark, zone, "place", "struct<lat: double, tags: array<string>>")
        assert promoted_fields(spark, zone) == {"battery": "int", "place": "struct<lat: double, tags: array<string>>"}
        got = with_promoted(read(spark, zone), promoted_fields(spark, zone)).collect()
        assert sorted((r.battery is not None, r.battery or 0) for r in got) == [(False, 0), (False, 0), (True, 87)]
        assert [(r.place.lat, r.place.tags) for r in got if r.place] == [(1.5, ["a"])]
        assert [r.rest for r in got if r.rest] == [{"note": "é"}]
    with pytest.raises(ValueError):
        promote(spark, f"{tmp_dir}/r", C.HEART_BEAT, "int")
    assert with_promoted(read_refine(spark, f"{tmp_dir}/r"), {}).columns[-1] == C.REST


def state(spark, root: str):
    passive = sorted(tuple(r) for r in warehouse.read_table(spark, root, "f_passive").select("subjectid", "timeid", "agg_value").collect())
    events = sorted(tuple(r) for r in warehouse.read_table(spark, root, "f_intentional").select("subjectid", "value").collect())
    table = warehouse.snapshots(spark, root, warehouse.QUARANTINE)
    kept = sorted((r.stage, r.reject_reason) for r in table.read().collect()) if table.exists() else []
    return passive, events, kept


def test_rejected_rows_reach_the_facts_once_after_a_mend(spark, tmp_dir, monkeypatch):
    zones, root = ZonePaths(f"{tmp_dir}/refine", f"{tmp_dir}/conform"), f"{tmp_dir}/wh"
    rows = [sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000", hb=60.0), sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000", subject="S3", hb=80.0),
            sensor(C.GYRO, "soon", subject="S1"), sensor("thermo", "2024-01-05T10:00:00+0000"),
            event(C.MIGRAINE, "2024-01-06T09:00:00+0000", severity="4", subject="S3", study="meal_study"),
            event(C.MIGRAINE, "2024-01-06T09:00:00+0000", severity="bad", study="meal_study")]
    dims = small_dims(spark)
    init_warehouse(spark, root, dims)
    run_batch(spark, raw_df(spark, rows), zones, dims, root, batch_tag="0")
    before = state(spark, root)
    assert before[2] == [("event", "bad_severity"), ("event", "no_allocation"), ("passive", "no_allocation"), ("refine", "bad_timestamp"), ("refine", "unknown_type")]
    kept = warehouse.snapshots(spark, root, warehouse.QUARANTINE).read().where("stage = 'refine'").collect()
    assert {json.loads(r.row)[C.DATA_TYPE] for r in kept} == {"thermo", C.GYRO}
    # a late reading of the hour that is still rejected, then the subject and its allocation are mended
    run_batch(spark, raw_df(spark, [sensor(C.HEART_RATE, "2024-01-05T10:40:00+0000", subject="S3", hb=90.0)]), zones, dims, root, batch_tag="1")
    mended = small_dims(spark, allocations=[(i, 1, 1, 1, i, 1, date(2024, 1, 1), date(2024, 1, 31)) for i in (1, 2, 3)])
    mended.d_subject = spark.createDataFrame([(1, None, "S1"), (2, None, "S2"), (3, None, "S3")], schemas.D_SUBJECT)
    warehouse.replace_dimension(spark, root, "d_subject", mended.d_subject)
    mend = lambda raw: raw.withColumn(C.MEASUREMENT_TIME, F.when(F.col(C.MEASUREMENT_TIME) == "soon", "2024-01-07T01:00:00+0000").otherwise(F.col(C.MEASUREMENT_TIME)))
    real = warehouse.upsert_passive
    calls = []

    def broken(*a):
        real(*a)
        calls.append(a)
        if len(calls) == 2:
            raise OSError("driver lost")

    monkeypatch.setattr(warehouse, "upsert_passive", broken)
    with pytest.raises(OSError):
        replay_quarantine(spark, zones, mended, root, mend)
    monkeypatch.setattr(warehouse, "upsert_passive", real)
    replay_quarantine(spark, zones, mended, root, mend)
    passive, events, left = state(spark, root)
    assert [(s, v) for s, _, v in passive] == [(1, 60.0), (1, 1.0), (3, 85.0)]
    assert events == [(3, 4)]
    assert left == [("event", "bad_severity"), ("refine", "unknown_type")]
    assert read_refine(spark, zones.refine).where(f"{C.DAY_P} = 7").count() == 1


def test_a_zone_is_taken_in_by_bytes_and_the_backlog_is_measured(spark, tmp_dir):
    zone, root, ckpt = f"{tmp_dir}/refine", f"{tmp_dir}/wh", f"{tmp_dir}/ckpt"
    rows = [sensor(C.HEART_RATE, f"2024-01-05T{h:02d}:{m}:00+0000", hb=60.0 + h) for h in (8, 9) for m in ("00", "30")]
    for i in range(2):
        write_refine(accepted(normalise(raw_df(spark, rows[i::2]))), zone, str(i))
    init_warehouse(spark, root, small_dims(spark))
    files, size = backlog(spark, zone, ckpt).first()
    assert files == 4 and size > 0
    run_incremental_facts(spark, zone, small_dims(spark), root, ckpt, max_bytes_per_trigger=size // 2 + 1)
    assert tuple(backlog(spark, zone, ckpt).first()) == (0, 0)
    batches = [n for n in os.listdir(f"{ckpt.removeprefix('file:')}/commits") if n.isdigit()]
    assert len(batches) >= 2
    assert sorted(r.agg_value for r in warehouse.read_table(spark, root, "f_passive").collect()) == [68.0, 69.0]
    write_refine(accepted(normalise(raw_df(spark, [sensor(C.HEART_RATE, "2024-01-05T08:59:00+0000", hb=71.0)]))), zone, "2")
    assert backlog(spark, zone, ckpt).first().files == 1
