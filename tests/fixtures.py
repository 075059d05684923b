"""Small hand-made inputs for rule tests (the edge rows of FIXTURES §4)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

from studylake import constants as C
from studylake import schemas
from studylake.dims import Dims
from studylake.sources import seed


def raw_df(spark: SparkSession, rows: list[dict]):
    names = [f.name for f in schemas.RAW.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.RAW)


def sensor(t: str, time: str, subject="S1", watch="W1", phone="P1", study="meal_study", hb=None, **kw) -> dict:
    d = {C.DATA_TYPE: t, C.STUDY_TYPE: study, C.SUBJECT_ID: subject, C.WATCH_ID: watch, C.PHONE_ID: phone,
         C.MEASUREMENT_TIME: time, C.HEART_BEAT: hb}
    d.update(kw)
    return d


def event(t: str, start: str, stop: str | None = None, severity=None, subject="S1", watch="W1", phone="P1",
          study="migraine_study") -> dict:
    return {C.DATA_TYPE: t, C.STUDY_TYPE: study, C.SUBJECT_ID: subject, C.WATCH_ID: watch, C.PHONE_ID: phone,
            C.START_TIME: start, C.STOP_TIME: stop, C.SEVERITY: severity}


def small_dims(spark: SparkSession, allocations=None, calendar=None) -> Dims:
    """Subject S1 -> 1, S2 -> 2; watch W1 -> 1; phone P1 -> 1; sites 1, 2; calendar Jan 2024 by default."""
    from datetime import datetime
    alloc = allocations if allocations is not None else [
        (1, 1, 1, 1, 1, 1, date(2024, 1, 1), date(2024, 1, 31)),
        (2, 1, 1, 2, 1, 1, date(2024, 1, 1), date(2024, 1, 31)),
    ]
    return Dims(
        d_subject=spark.createDataFrame([(1, None, "S1"), (2, None, "S2")], schemas.D_SUBJECT),
        d_study=seed.study_dim(spark),
        d_device=spark.createDataFrame([(1, "w", "watch", "W1", None)], schemas.D_DEVICE),
        d_mobile=spark.createDataFrame([(1, "p", "phone", "P1", None)], schemas.D_MOBILE),
        d_sensor=seed.sensor_dim(spark),
        d_eventtype=seed.eventtype_dim(spark),
        d_aggtype=seed.aggtype_dim(spark),
        d_site=spark.createDataFrame([(1, "a", None), (2, "b", None)], schemas.D_SITE),
        d_allocation=spark.createDataFrame(alloc, schemas.D_ALLOCATION),
        d_datetime=calendar if calendar is not None else seed.calendar(spark, datetime(2024, 1, 1), datetime(2024, 1, 31, 23)),
    )
