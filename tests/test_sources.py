"""Sources and checks: corrupt JSON lines, backfill folder lists, PK/FK checks, observed counts."""

from __future__ import annotations

from studylake import constants as C
from studylake.operators.normalise import normalise
from studylake.operators.quality import fk_violations, pk_violations
from studylake.plans import jobs
from studylake.plans.jobs import ZonePaths, init_warehouse
from studylake.sinks import warehouse
from studylake.sources.raw import read_raw
from studylake.sources.zones import read_refine
from studylake.streaming.incremental import run_incremental_facts
from tests.fixtures import raw_df, sensor, small_dims


def _write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def test_corrupt_json_line_is_rejected_not_lost(spark, tmp_dir):
    good = '{"data_type":"gyro","study_type":"meal_study","subject_id":"S1","watch_unique_id":"W1",' \
           '"phone_unique_id":"P1","measurement_time":"2024-01-05T10:00:00+0000","x_gyro":1.5}'
    _write_lines(spark, f"{tmp_dir}/2024/01/05/10", [good, "{not json"])
    raw = read_raw(spark, f"{tmp_dir}/*/*/*/*")
    got = sorted((r["reject_reason"] or "ok") for r in normalise(raw).collect())
    assert got == [C.R_CORRUPT, "ok"]


def test_backfill_reads_chosen_hour_folders(spark, tmp_dir):
    for h in ("10", "11", "12"):
        line = ('{"data_type":"gyro","subject_id":"S1","measurement_time":"2024-01-05T%s:00:00+0000"}' % h)
        _write_lines(spark, f"{tmp_dir}/2024/01/05/{h}", [line])
    raw = read_raw(spark, [f"{tmp_dir}/2024/01/05/10", f"{tmp_dir}/2024/01/05/12"], base_path=tmp_dir)
    assert sorted(r[C.MEASUREMENT_TIME][11:13] for r in raw.collect()) == ["10", "12"]


def test_pk_and_fk_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id int, v string")
    got = {(r["id"], r["rows"]) for r in pk_violations(df, ["id"]).collect()}
    assert got == {(1, 2), (None, 1)}
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    fact = spark.createDataFrame([(1, 5), (3, 5), (3, 1), (None, 2)], "a int, b int")
    fk = sorted(tuple(r) for r in fk_violations(fact, [("a", dim, "k"), ("b", dim, "k")]).collect())
    assert fk == [("a", 3, 2), ("b", 5, 2)]


def test_observed_run_counts(spark, tmp_dir):
    raw = raw_df(spark, [sensor(C.GYRO, "2024-01-05T10:00:00+0000"), sensor(C.GYRO, "bad")])
    refined = jobs.refine_and_conform(spark, raw, ZonePaths(f"{tmp_dir}/r", f"{tmp_dir}/c"))
    refined.unpersist()
    assert refined.metrics == {"records": 2, "accepted": 1, "rejected": 1}


def test_facts_job_streams_from_refine(spark, tmp_dir):
    dims = small_dims(spark)
    zones = ZonePaths(refine=f"{tmp_dir}/refine", conform=f"{tmp_dir}/conform")
    root = f"{tmp_dir}/wh"
    init_warehouse(spark, root, dims)
    jobs.refine_and_conform(spark, raw_df(spark, [sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000", hb=60.0)]), zones)
    run_incremental_facts(spark, zones.refine, dims, root, f"{tmp_dir}/ckpt")
    assert [r["agg_value"] for r in warehouse.read_table(spark, root, "f_passive").collect()] == [60.0]
    jobs.refine_and_conform(spark, raw_df(spark, [sensor(C.HEART_RATE, "2024-01-05T10:30:00+0000", hb=80.0)]), zones)
    run_incremental_facts(spark, zones.refine, dims, root, f"{tmp_dir}/ckpt")
    assert [r["agg_value"] for r in warehouse.read_table(spark, root, "f_passive").collect()] == [70.0]
    assert read_refine(spark, zones.refine).count() == 2
