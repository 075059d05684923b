"""Static dimension seed (S-9) and calendar generators (S-10, J-12)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas


def _seed(spark: SparkSession, rows, schema) -> DataFrame:
    width = len(schema.fields)
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def aggtype_dim(spark: SparkSession) -> DataFrame:
    return _seed(spark, C.AGGTYPE_SEED, schemas.D_AGGTYPE)


def eventtype_dim(spark: SparkSession) -> DataFrame:
    return _seed(spark, C.EVENTTYPE_SEED, schemas.D_EVENTTYPE)


def sensor_dim(spark: SparkSession) -> DataFrame:
    return _seed(spark, C.SENSOR_SEED, schemas.D_SENSOR)


def study_dim(spark: SparkSession) -> DataFrame:
    return _seed(spark, C.STUDY_SEED, schemas.D_STUDY)


def _calendar_columns(t, timeid):
    return [
        timeid.cast("int").alias("timeid"),
        F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("date"), F.hour(t).alias("hour"),
        F.lit(None).cast("int").alias("min"),
    ]


def calendar_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Calendar of every real hour from ``lo`` to ``hi`` (inclusive) of a one-row frame.

    The hour count is bounded by the span of the range (8,784 a year), so the
    rows are generated lazily inside the plan with no driver round trip.
    """
    hours = bounds.select(F.col(lo).alias("lo"), F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("t"))
    timeid = (F.unix_seconds("t") - F.unix_seconds("lo")) / 3600 + 1
    return hours.select(*_calendar_columns(F.col("t"), timeid))


def calendar(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """Calendar of every real hour in [start, end], distributed by ``spark.range`` (D-3 change)."""
    n = int((end - start).total_seconds() // 3600) + 1
    t = F.timestamp_add("HOUR", F.col("id"), F.lit(start).cast("timestamp"))
    return spark.range(n).select(*_calendar_columns(t, F.col("id") + 1))


def legacy_calendar(spark: SparkSession) -> DataFrame:
    """The original 4,464-row calendar: each listed month × day 1..31 × hour 0..23,
    ``timeid`` sequential in that order, impossible dates included (D-3 legacy)."""
    per_month = 31 * 24
    n = len(C.LEGACY_CALENDAR_MONTHS) * per_month
    idx = (F.col("id") / per_month).cast("int") + 1
    years = F.array(*[F.lit(y) for y, _ in C.LEGACY_CALENDAR_MONTHS])
    months = F.array(*[F.lit(m) for _, m in C.LEGACY_CALENDAR_MONTHS])
    return spark.range(n).select(
        (F.col("id") + 1).cast("int").alias("timeid"),
        F.element_at(years, idx).alias("year"),
        F.element_at(months, idx).alias("month"),
        ((F.col("id") / 24).cast("int") % 31 + 1).cast("int").alias("date"),
        (F.col("id") % 24).cast("int").alias("hour"),
        F.lit(None).cast("int").alias("min"),
    )
