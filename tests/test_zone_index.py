"""S-2: the partition index of a refine zone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from studylake import constants as C
from studylake.operators.aggregate import affected_hours
from studylake.operators.normalise import accepted, normalise
from studylake.sinks.zones import write_refine
from studylake.sources import adapter
from studylake.sources.zone_index import HOURS, read_hours, read_index
from studylake.sources.zones import read_refine
from tests.conftest import SF0001
from tests.fixtures import raw_df, sensor


def test_a_pruned_read_lists_the_touched_folders_only(spark, tmp_dir):
    ref = accepted(normalise(adapter.study_raw(spark, SF0001))).cache()
    for tag, odd in (("a", 0), ("b", 1)):
        write_refine(ref.filter(F.col(C.DAY_P) % 2 == odd), tmp_dir, tag)
    index = read_index(spark, tmp_dir)
    assert index.agg(F.sum("rows")).first()[0] == ref.count()
    assert index.where("rows <= 0 or first_time > last_time").count() == 0
    late = ref.filter(F.col(C.DAY_P) >= 28)
    got = read_hours(spark, tmp_dir, late, [C.HEART_RATE])
    hours = {tuple(r) for r in late.select(*HOURS).distinct().collect()}
    folders = {tuple(int(p.split("=")[1]) for p in f.split("/")[-5:-1]) for f in got.inputFiles()}
    assert folders <= hours and all("=heart_rate/" in f for f in got.inputFiles())
    whole = read_refine(spark, tmp_dir)
    assert len(got.inputFiles()) < len(whole.inputFiles()) / 5
    assert got.count() == ref.filter((F.col(C.DAY_P) >= 28) & (F.col(C.TYPE_P) == C.HEART_RATE)).count()
    show = lambda df: sorted(str(tuple(r)) for r in df.withColumn("mean_hr", F.round("mean_hr", 9)).collect())
    assert show(affected_hours(late, got)) == show(affected_hours(late, whole))
    ref.unpersist()


def test_replays_untagged_batches_and_hours_of_no_row(spark, tmp_dir):
    one = accepted(normalise(raw_df(spark, [sensor(C.GYRO, "2024-01-05T10:20:00+0000")])))
    for _ in range(2):
        write_refine(one, f"{tmp_dir}/tagged", "q-1")
        write_refine(one, f"{tmp_dir}/plain")
    assert read_index(spark, f"{tmp_dir}/tagged").agg(F.sum("rows")).first()[0] == 1
    assert read_index(spark, f"{tmp_dir}/plain").agg(F.sum("rows")).first()[0] == 2
    assert read_hours(spark, f"{tmp_dir}/plain", one).count() == 2
    other = accepted(normalise(raw_df(spark, [sensor(C.GYRO, "2024-01-05T11:20:00+0000")])))
    assert read_hours(spark, f"{tmp_dir}/tagged", other).count() == 0
    assert read_hours(spark, f"{tmp_dir}/tagged", one, [C.HEART_RATE]).count() == 0
    assert read_hours(spark, f"{tmp_dir}/tagged", one.limit(0)).count() == 0
    assert read_refine(spark, f"{tmp_dir}/tagged").count() == 1  # the index is no part of the zone
    with pytest.raises(ValueError):
        read_hours(spark, f"{tmp_dir}/none", one)
