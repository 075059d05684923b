"""F4-F8: steps that used to read or parse their input several times."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas
from studylake.catalog import _planted_refs
from studylake.functions.times import OFFSET_TIME_FORMAT, parse_raw_time
from studylake.operators.aggregate import hour_partials, hour_sums, partials_of
from studylake.operators.allocation import settled
from studylake.operators.normalise import accepted, normalise
from tests.fixtures import event, raw_df, sensor, small_dims


def _optimised(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_accept_filter_does_not_parse_again(spark):
    raw = raw_df(spark, [sensor(C.GYRO, "2024-01-05T10:20:00+0000")]).withColumn(C.MEASUREMENT_TIME, F.concat(C.MEASUREMENT_TIME, F.lit("")))
    filters = [line for line in _optimised(accepted(normalise(raw.repartition(2)))).splitlines() if "Filter" in line]
    assert filters and not any("gettimestamp" in line.lower() for line in filters)


def test_times_are_read_as_by_the_patterns(spark):
    at = "2024-01-05T10:20:30"
    texts = [at + o for o in ("+0000", "-0000", "+0530", "+1800", "+1801", "+0060", "Z", "", "GMT-06:00", "+0000\n", ".5+0000")]
    texts += [d + "T10:20:30+0000" for d in ("2024-02-29", "2023-02-29", "2024-13-01", "0001-01-01", "9999-12-31", "2024-1-5")] + [None, "junk", "2024-01-05T24:00:00+0000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old = F.coalesce(F.try_to_timestamp("t", F.lit(OFFSET_TIME_FORMAT)), F.try_to_timestamp("t", F.lit(C.RAW_TIME_FORMAT)))
    assert df.select("t", F.unix_micros(old).alias("a"), F.unix_micros(parse_raw_time("t")).alias("b")).where("not a <=> b").collect() == []


def test_the_state_of_a_batch_from_its_sums(spark):
    rows = [sensor(C.HEART_RATE, f"2024-01-05T10:{i}0:00+0000", hb=hb) for i, hb in enumerate((60.0, None, 71.0))]
    rows += [sensor(C.HEART_RATE, "2024-01-05T11:00:00+0000"), sensor(C.GYRO, "2024-01-05T10:00:00+0000"), event(C.MEAL, "2024-01-05T10:00:00+0000")]
    ref = accepted(normalise(raw_df(spark, rows)))
    show = lambda df: sorted(map(str, df.select(*C.HOUR_GROUP_KEYS, "state_date", "hb_sum", "hb_count").collect()))
    assert show(partials_of(hour_sums(ref))) == show(hour_partials(ref)) != []


def test_overlaps_are_settled_once_a_load(spark):
    kept = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    dims, before = small_dims(spark), kept()
    with settled(dims), settled(dims):
        segs = dims._derived["disjoint_allocation"]
        assert segs.count() == 2 and segs.storageLevel.useMemory and kept() > before
    assert kept() == before


def test_planted_references_read_the_table_once(spark):
    rows = [(i, i, i, 1, i, i, date(2024, 1, 1), None) for i in (3, 4, 10)] + [(9, None, 1, 1, None, 1, None, None)]
    df = spark.createDataFrame(rows, schemas.D_ALLOCATION)
    out = _planted_refs(df, "d_allocation")
    plan = _optimised(out)
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    broken = [(3, -4, -4, -2, -4, -4, date(2024, 1, 1), None), (10, -11, -11, -2, -11, -11, date(2024, 1, 1), None)]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, rows + broken)) and out.columns == df.columns
