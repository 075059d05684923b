"""Golden rows for the semantic rules D-1..D-13 and the edge cases of FIXTURES §4."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas
from studylake.operators import facts
from studylake.operators.allocation import allocate_site
from studylake.operators.lookups import resolve_time
from studylake.operators.normalise import accepted, normalise
from studylake.operators.rejects import reject_rows, summarise_rejects
from studylake.plans.jobs import ZonePaths, init_warehouse, run_batch
from studylake.sinks import warehouse
from studylake.sinks.zones import write_conform
from studylake.sources import seed
from studylake.sources.zones import read_conform
from tests.fixtures import event, raw_df, sensor, small_dims


def _ids_frame(spark, rows):
    return spark.createDataFrame(rows, "mobileid int, studyid int, subjectid int, deviceid int, d date")


def test_d1_calendar_keys_do_not_collide(spark):
    dims = small_dims(spark, calendar=seed.legacy_calendar(spark))
    df = spark.createDataFrame([(2019, 10, 1, 10), (2019, 10, 11, 0)],
                               f"{C.YEAR_P} int, {C.MONTH_P} int, {C.DAY_P} int, {C.HOUR_P} int")
    got = {(r[C.DAY_P], r[C.HOUR_P]): r["timeid"] for r in resolve_time(df, dims).collect()}
    assert got == {(1, 10): 11, (11, 0): 241}


def test_d1_allocation_keys_do_not_collide(spark):
    dims = small_dims(spark, allocations=[(1, 11, 1, 1, 1, 1, date(2024, 1, 1), date(2024, 1, 31))])
    df = _ids_frame(spark, [(1, 11, 1, 1, date(2024, 1, 5)), (11, 1, 1, 1, date(2024, 1, 5))])
    got = {r["mobileid"]: r["siteid"] for r in allocate_site(df, dims, "d").collect()}
    assert got == {11: 1, 1: 0}


def test_d2_disjoint_and_overlapping_periods(spark):
    alloc = [
        (1, 1, 1, 1, 1, 1, date(2024, 1, 1), date(2024, 1, 10)),
        (2, 1, 2, 1, 1, 1, date(2024, 1, 11), date(2024, 1, 20)),
        (5, 1, 1, 1, 1, 1, date(2024, 1, 18), None),  # open-ended, overlaps the second, higher id
    ]
    dims = small_dims(spark, allocations=alloc)
    days = [date(2024, 1, 5), date(2024, 1, 12), date(2024, 1, 19), date(2025, 6, 1)]
    df = _ids_frame(spark, [(1, 1, 1, 1, d) for d in days])
    got = {r["d"]: r["siteid"] for r in allocate_site(df, dims, "d").collect()}
    assert got == {date(2024, 1, 5): 1, date(2024, 1, 12): 2, date(2024, 1, 19): 1, date(2025, 6, 1): 1}


def test_j9_inclusive_bounds(spark):
    dims = small_dims(spark, allocations=[(1, 1, 2, 1, 1, 1, date(2024, 1, 10), date(2024, 1, 20))])
    days = [date(2024, 1, 9), date(2024, 1, 10), date(2024, 1, 20), date(2024, 1, 21)]
    df = _ids_frame(spark, [(1, 1, 1, 1, d) for d in days])
    got = {r["d"]: r["siteid"] for r in allocate_site(df, dims, "d").collect()}
    assert got == {date(2024, 1, 9): 0, date(2024, 1, 10): 2, date(2024, 1, 20): 2, date(2024, 1, 21): 0}


def test_d3_real_calendar_vs_legacy(spark):
    legacy = seed.legacy_calendar(spark)
    assert legacy.count() == 4464
    assert legacy.filter("year = 2019 and month = 11 and date = 31").count() == 24
    from datetime import datetime
    real = seed.calendar(spark, datetime(2019, 10, 1), datetime(2020, 3, 31, 23))
    assert real.filter("year = 2019 and month = 11 and date = 31").count() == 0
    assert real.count() == (31 + 30 + 31 + 31 + 29 + 31) * 24


def test_d3_d10_hour_outside_calendar_is_rejected_unknown_time(spark):
    dims = small_dims(spark)
    raw = raw_df(spark, [sensor(C.GYRO, "2024-02-02T10:00:00+0000")])
    dims_feb = small_dims(spark, allocations=[(1, 1, 1, 1, 1, 1, date(2024, 1, 1), date(2024, 3, 1))])
    pv = facts.resolve_passive(accepted(normalise(raw)), dims_feb)
    assert [r["reject_reason"] for r in pv.collect()] == [C.R_UNKNOWN_TIME]
    assert dims  # calendar of the fixture ends 2024-01-31


def test_d4_time_formats(spark):
    from studylake.functions.times import parse_raw_time
    texts = ["2024-01-01T10:00:00-0600", "2024-01-01T10:00:00GMT-06:00", "2024-01-01T10:00:00.123-0600", "bad", ""]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", parse_raw_time("s").alias("t"))
    got = {r["s"]: (r["t"].strftime("%Y-%m-%d %H:%M:%S") if r["t"] else None) for r in df.collect()}
    assert got["2024-01-01T10:00:00-0600"] == "2024-01-01 16:00:00"
    assert got["2024-01-01T10:00:00GMT-06:00"] == "2024-01-01 16:00:00"
    assert got["2024-01-01T10:00:00.123-0600"] is None and got["bad"] is None and got[""] is None


def test_d5_subject_code_stays_text(spark, tmp_dir):
    raw = raw_df(spark, [sensor(C.GYRO, "2024-01-01T10:00:00+0000", subject="007")])
    write_conform(accepted(normalise(raw)), tmp_dir)
    back = read_conform(spark, tmp_dir).collect()
    assert back[0][C.SUBJECT_P] == "007" and back[0][C.SUBJECT_ID] == "007"


def test_d6_d8_bad_time_and_type_are_rejected(spark):
    raw = raw_df(spark, [
        sensor(C.GYRO, None), sensor(C.GYRO, "yesterday"), sensor(None, "2024-01-01T10:00:00+0000"),
        sensor("barometer", "2024-01-01T10:00:00+0000"), sensor(C.GYRO, "2024-01-01T10:00:00+0000"),
    ])
    reasons = sorted((r["reject_reason"] or "ok") for r in normalise(raw).collect())
    assert reasons == sorted([C.R_BAD_TIMESTAMP, C.R_BAD_TIMESTAMP, C.R_UNKNOWN_TYPE, C.R_UNKNOWN_TYPE, "ok"])


def test_d7_reccount_counts_groups_source_records_counts_rows(spark):
    dims = small_dims(spark, allocations=[])
    rows = [sensor(C.GYRO, f"2024-01-05T10:0{i}:00+0000") for i in range(3)] + \
           [sensor(C.GYRO, f"2024-01-05T11:0{i}:00+0000") for i in range(4)]
    pv = facts.resolve_passive(accepted(normalise(raw_df(spark, rows))), dims)
    s = summarise_rejects(reject_rows(pv, "passive", "rec_count")).collect()
    assert len(s) == 1 and s[0]["reccount"] == 2 and s[0]["source_records"] == 7
    assert s[0]["reject_reason"] == C.R_NO_ALLOCATION


def test_d11_bad_severity_and_no_measurement(spark):
    dims = small_dims(spark)
    raw = raw_df(spark, [
        event(C.MIGRAINE, "2024-01-05T10:00:00+0000", severity=None),
        event(C.MIGRAINE, "2024-01-05T11:00:00+0000", severity="x"),
        event(C.MIGRAINE, "2024-01-05T12:00:00+0000", severity=" 7 "),
        sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000", hb=None),
    ])
    ref = accepted(normalise(raw))
    ev = {r[C.START_TIME].hour: (r["reject_reason"], r["value"]) for r in facts.resolve_events(ref, dims).collect()}
    assert ev == {10: (C.R_BAD_SEVERITY, None), 11: (C.R_BAD_SEVERITY, None), 12: (None, 7)}
    pv = facts.resolve_passive(ref, dims).collect()
    assert [r["reject_reason"] for r in pv] == [C.R_NO_MEASUREMENT]


def test_d13_null_and_quoted_codes(spark):
    dims = small_dims(spark)
    raw = raw_df(spark, [
        sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000", watch=None, hb=60.0),
        sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000", watch="W'1", hb=70.0),
    ])
    pv = facts.resolve_passive(accepted(normalise(raw)), dims).collect()
    assert sorted(r["reject_reason"] for r in pv) == [C.R_NO_ALLOCATION, C.R_NO_ALLOCATION]
    assert sorted(r["agg_value"] for r in pv) == [60.0, 70.0]


def test_p11_meal_only_batch_without_severity_column(spark):
    dims = small_dims(spark)
    df = spark.createDataFrame(
        [(C.MEAL, "migraine_study", "S1", "W1", "P1", "2024-01-05T10:00:00+0000", "2024-01-05T10:30:00+0000")],
        [C.DATA_TYPE, C.STUDY_TYPE, C.SUBJECT_ID, C.WATCH_ID, C.PHONE_ID, C.START_TIME, C.STOP_TIME])
    out = facts.event_fact(facts.resolve_events(accepted(normalise(df)), dims)).collect()
    assert [(r["value"], r["siteid"], r["evtypid"]) for r in out] == [(-1, 1, 1)]


def _wh(spark, base, dims):
    zones = ZonePaths(refine=f"{base}/refine", conform=f"{base}/conform")
    root = f"{base}/wh"
    init_warehouse(spark, root, dims)
    return zones, root


def test_j11_k5_late_reading_reopens_its_hour(spark, tmp_dir):
    dims = small_dims(spark)
    zones, root = _wh(spark, tmp_dir, dims)
    first = raw_df(spark, [sensor(C.HEART_RATE, "2024-01-05T10:00:00+0000", hb=60.0),
                           sensor(C.HEART_RATE, "2024-01-05T10:10:00+0000", hb=80.0)])
    run_batch(spark, first, zones, dims, root)
    got = warehouse.read_table(spark, root, "f_passive").collect()
    assert [r["agg_value"] for r in got] == [70.0]
    late = raw_df(spark, [sensor(C.HEART_RATE, "2024-01-05T10:50:00+0000", hb=100.0)])
    run_batch(spark, late, zones, dims, root)
    got = warehouse.read_table(spark, root, "f_passive").collect()
    assert [r["agg_value"] for r in got] == [80.0]


def test_d12_event_loaded_twice(spark, tmp_dir):
    dims = small_dims(spark)
    raw = raw_df(spark, [event(C.MIGRAINE, "2024-01-05T10:00:00+0000", "2024-01-05T11:00:00+0000", severity="4")])
    fact = facts.event_fact(facts.resolve_events(accepted(normalise(raw)), dims))
    root = f"{tmp_dir}/dedup"
    warehouse.append_events(spark, root, fact)
    warehouse.append_events(spark, root, fact)
    assert warehouse.read_table(spark, root, "f_intentional").count() == 1
    root2 = f"{tmp_dir}/append_only"
    warehouse.append_events(spark, root2, fact, dedup=False)
    warehouse.append_events(spark, root2, fact, dedup=False)
    assert warehouse.read_table(spark, root2, "f_intentional").count() == 2


def test_k6_run_without_rejects_empties_reject_table(spark, tmp_dir):
    dims = small_dims(spark)
    zones, root = _wh(spark, tmp_dir, dims)
    run_batch(spark, raw_df(spark, [sensor(C.GYRO, "2024-01-05T10:00:00+0000", subject="S9")]), zones, dims, root)
    assert warehouse.read_table(spark, root, "rejects").count() == 1
    assert warehouse.read_table(spark, root, "temp_allocation_error_records").count() == 1
    run_batch(spark, raw_df(spark, [sensor(C.GYRO, "2024-01-05T11:00:00+0000")]), zones, dims, root)
    assert warehouse.read_table(spark, root, "rejects").count() == 0
    assert warehouse.read_table(spark, root, "f_passive").count() == 1


def test_s5_empty_delta_writes_nothing(spark, tmp_dir):
    dims = small_dims(spark)
    zones, root = _wh(spark, tmp_dir, dims)
    assert run_batch(spark, raw_df(spark, []), zones, dims, root) is None
    assert warehouse.read_table(spark, root, "f_passive").count() == 0


def test_p7_trim_strings(spark):
    from studylake.functions.columns import trim_strings
    df = spark.createDataFrame([("  a ", 1, " b")], "x string, n int, y string")
    assert trim_strings(df).collect()[0].asDict() == {"x": "a", "n": 1, "y": "b"}


def test_schema_conform_adds_typed_nulls(spark):
    df = spark.createDataFrame([("gyro",)], [C.DATA_TYPE])
    out = schemas.conform_to(df, schemas.RAW)
    assert out.schema == schemas.RAW
    assert out.filter(F.col(C.SEVERITY).isNull()).count() == 1
