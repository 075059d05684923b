"""Incremental runs (S-3, R-1): each availableNow run loads only the files not seen before."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from studylake import constants as C
from studylake.plans.jobs import ZonePaths, init_warehouse
from studylake.sinks import warehouse
from studylake.sources import adapter
from studylake.sources.zones import read_refine
from studylake.streaming.incremental import run_incremental
from tests.conftest import SF0001


def test_available_now_twice(spark, tmp_dir):
    raw = adapter.study_raw(spark, SF0001).drop(C.CORRUPT)
    dims = adapter.study_dims(spark, SF0001)
    zones = ZonePaths(refine=f"{tmp_dir}/refine", conform=f"{tmp_dir}/conform")
    root, ckpt, raw_dir = f"{tmp_dir}/wh", f"{tmp_dir}/ckpt", f"{tmp_dir}/raw"
    init_warehouse(spark, root, dims)
    first = raw.filter(F.col(C.STUDY_TYPE) == "meal_study")
    second = raw.filter(F.col(C.STUDY_TYPE) != "meal_study")
    first.write.json(f"{raw_dir}/hour=1")
    run_incremental(spark, raw_dir, zones, dims, root, ckpt)
    n1 = read_refine(spark, zones.refine).count()
    assert n1 == first.count()
    run_incremental(spark, raw_dir, zones, dims, root, ckpt)  # nothing new: nothing loaded
    assert read_refine(spark, zones.refine).count() == n1
    second.write.json(f"{raw_dir}/hour=2")
    run_incremental(spark, raw_dir, zones, dims, root, ckpt)
    assert read_refine(spark, zones.refine).count() == raw.count()
    assert warehouse.read_table(spark, root, "f_passive").count() > 0


class _Endless:
    stopped = False

    def awaitTermination(self, timeout):
        return False

    def stop(self):
        self.stopped = True


def test_a_run_that_hits_its_time_limit_raises():
    from studylake.streaming.incremental import _finish

    q = _Endless()
    with pytest.raises(TimeoutError):
        _finish(q, 1)
    assert q.stopped


def _write_drop(raw, path):
    raw.drop(C.CORRUPT).coalesce(1).write.json(path)


def test_rejects_of_a_split_run_are_the_whole_runs(spark, tmp_dir):
    """One file a micro-batch: the reject tables hold the rejects of every micro-batch of the run
    (an hourly group met twice counts once), and the next run's replace them."""
    from tests.fixtures import raw_df, sensor, small_dims
    drops = [[sensor(C.GYRO, "2024-03-05T10:00:00+0000"), sensor(C.GYRO, "bad"),
              sensor(C.GYRO, "2024-03-06T10:00:00+0000")],
             [sensor(C.GYRO, "2024-03-05T11:00:00+0000"), sensor(C.GYRO, "2024-03-06T10:30:00+0000")]]
    out = {}
    for files in (1, 100):
        base = f"{tmp_dir}/{files}"
        zones = ZonePaths(refine=f"{base}/refine", conform=f"{base}/conform")
        init_warehouse(spark, f"{base}/wh", small_dims(spark))
        for i, rows in enumerate(drops):
            _write_drop(raw_df(spark, rows), f"{base}/raw/hour={i}")
        args = (spark, f"{base}/raw", zones, small_dims(spark), f"{base}/wh", f"{base}/ckpt")
        run_incremental(*args, max_files_per_trigger=files)
        out[files] = [sorted(map(str, warehouse.read_table(spark, f"{base}/wh", t).collect()))
                      for t in ("rejects", "temp_allocation_error_records")]
    assert out[1] == out[100]
    rejects = {r["reject_reason"]: (r["reccount"], r["source_records"])
               for r in warehouse.read_table(spark, f"{tmp_dir}/1/wh", "rejects").collect()}
    assert rejects == {"no_allocation": (3, 4), "bad_timestamp": (1, 1)}
    _write_drop(raw_df(spark, [sensor(C.GYRO, "worse")]), f"{base}/raw/hour=2")
    run_incremental(*args, max_files_per_trigger=1)
    again = warehouse.read_table(spark, f"{base}/wh", "rejects").collect()
    assert [(r["reject_reason"], r["reccount"]) for r in again] == [("bad_timestamp", 1)]


def test_no_batch_stays_persisted(spark, tmp_dir, monkeypatch):
    from studylake.plans import jobs
    from tests.fixtures import raw_df, sensor, small_dims
    kept = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = kept()
    zones = ZonePaths(refine=f"{tmp_dir}/refine", conform=f"{tmp_dir}/conform")
    dims, root = small_dims(spark), f"{tmp_dir}/wh"
    init_warehouse(spark, root, dims)
    raw = raw_df(spark, [sensor(C.GYRO, "2024-01-05T10:00:00+0000")])
    jobs.run_batch(spark, raw, zones, dims, root, batch_tag="a")
    assert kept() == before
    monkeypatch.setattr(jobs, "write_conform", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        jobs.run_batch(spark, raw, zones, dims, root, batch_tag="b")
    assert kept() == before


def test_hours_outside_the_calendar_give_the_same_mean_with_and_without_dims(spark):
    from studylake.operators import aggregate
    from studylake.operators.normalise import accepted, normalise
    from tests.fixtures import raw_df, sensor, small_dims
    ref = accepted(normalise(raw_df(spark, [sensor(C.HEART_RATE, "2031-03-05T10:00:00+0000", hb=70.0),
                                            sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000", hb=60.0)])))
    rows = lambda dims: sorted(map(str, aggregate.affected_hours(ref, ref, dims).collect()))
    free = rows(None)
    assert rows(small_dims(spark)) == free and any("70.0" in r for r in free)


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    from types import SimpleNamespace

    from studylake.session import shared_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        shared_dir(SimpleNamespace(sparkContext=sc))
