"""Adapter: the driver's TPC-H-style tables re-read as study data.

Everything here is derived from the given tables, so the work grows with them:
``events`` becomes raw study records, ``customer`` becomes subjects and their
allocations, ``supplier`` becomes watches and phones, ``nation`` becomes sites,
and the calendar spans the months the events cover.  The same derivation is
written as DuckDB SQL in :mod:`studylake.oracle` for the correctness check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas
from studylake.dims import Dims
from studylake.sources.seed import aggtype_dim, calendar_between, eventtype_dim, sensor_dim, study_dim

# Fixed values of the adapter: driver event type -> study record type.
EVENT_TYPE_MAP = {"click": C.ACCELEROMETER, "view": C.GYRO, "purchase": C.HEART_RATE, "error": C.MIGRAINE, "signup": C.MEAL}
# Fixed values of the adapter: (user_id % 3) -> written UTC offset and its minutes.
OFFSETS = [("+0000", 0), ("-0600", -360), ("+0530", 330)]
# Allocation periods start on this day plus (c_custkey % 10) days and last 14 days.
ALLOCATION_BASE_DATE = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text_time(ts: Column, offset_minutes: Column, suffix: Column) -> Column:
    local = F.timestamp_add("MINUTE", offset_minutes, ts)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), suffix)


def _code(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def gadget_count(supplier: DataFrame) -> Column:
    """Number of watches, and of phones: one of each per supplier (keys from 0)."""
    return supplier.agg(F.count(F.lit(1))).scalar()


def raw_records(events: DataFrame, gadgets: Column) -> DataFrame:
    """Driver ``events`` -> raw study records (RAW schema, times as offset text).  A user wears the watch and holds
    the phone of their id modulo the number of gadgets."""
    mapping = F.create_map(*[x for kv in EVENT_TYPE_MAP.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    dt = mapping[F.col("event_type")]
    is_sensor = dt.isin(*C.SENSOR_TYPES)
    is_event = dt.isin(*C.EVENT_TYPES)
    k = (F.col("user_id") % 3).cast("int")
    suffix = F.element_at(F.array(*[F.lit(s) for s, _ in OFFSETS]), k + 1)
    minutes = F.element_at(F.array(*[F.lit(m) for _, m in OFFSETS]), k + 1)
    ts = F.col("ts")
    text = _text_time(ts, minutes, suffix)
    v = F.col("value")
    when = lambda cond, c: F.when(cond, c)
    cols = {
        C.DATA_TYPE: dt,
        C.STUDY_TYPE: F.when(F.col("event_id") % 2 == 0, F.lit("meal_study")).otherwise(F.lit("migraine_study")),
        C.SUBJECT_ID: _code("S", F.col("user_id")),
        C.DEVICE_MODEL: _code("model-", F.col("user_id") % 4),
        C.PHONE_ID: _code("P", F.col("user_id") % gadgets),
        C.WATCH_ID: _code("W", F.col("user_id") % gadgets),
        C.SOURCE_TYPE: F.when(is_sensor, F.lit("watch")).otherwise(F.lit("phone")),
        C.SYSTEM_NAME: F.when(is_sensor, F.lit("watch_os")).otherwise(F.lit("phone_os")),
        C.SYSTEM_VERSION: _code("1.", F.col("user_id") % 4),
        C.MEASUREMENT_TIME: when(is_sensor, text),
        C.X_ACC: when(dt == C.ACCELEROMETER, v),
        C.Y_ACC: when(dt == C.ACCELEROMETER, v + 1.0),
        C.Z_ACC: when(dt == C.ACCELEROMETER, v - 1.0),
        C.X_GYRO: when(dt == C.GYRO, v),
        C.Y_GYRO: when(dt == C.GYRO, v * 2.0),
        C.Z_GYRO: when(dt == C.GYRO, -v),
        C.HEART_BEAT: when(dt == C.HEART_RATE, v),
        C.ADDED_TO_HEALTH: when(dt == C.HEART_RATE, text),
        C.DATA_SYNC: when(dt == C.HEART_RATE, _text_time(F.timestamp_add("MINUTE", F.lit(1), ts), minutes, suffix)),
        C.ADDED_TO_HEALTH_MS: when(dt == C.HEART_RATE, F.unix_millis(ts.cast("timestamp"))),
        C.DATA_SYNC_MS: when(dt == C.HEART_RATE, F.unix_millis(ts.cast("timestamp")) + 60000),
        C.START_TIME: when(is_event, text),
        C.STOP_TIME: when(is_event, _text_time(F.timestamp_add("MINUTE", F.lit(30), ts), minutes, suffix)),
        C.SEVERITY: when(dt == C.MIGRAINE, (F.floor(v).cast("int") % 10).cast("string")),
        C.CORRUPT: F.lit(None).cast("string"),
    }
    return schemas.conform_to(events.select(*[c.alias(n) for n, c in cols.items()]), schemas.RAW)


def subject_dim(customer: DataFrame) -> DataFrame:
    """Subjects: customers whose key is not 6 mod 7 (the rest stay unknown)."""
    return schemas.conform_to(
        customer.filter(F.col("c_custkey") % 7 != 6).select(
            (F.col("c_custkey") + 1).alias("subjectid"),
            _code("S", F.col("c_custkey")).alias("subject_uniquecd"),
        ),
        schemas.D_SUBJECT,
    )


def _gadget_dim(supplier: DataFrame, prefix: str, kind: str, schema) -> DataFrame:
    idc, name, typ, code = [f.name for f in schema.fields[:4]]
    return schemas.conform_to(
        supplier.select(
            (F.col("s_suppkey") + 1).alias(idc), F.col("s_name").alias(name), F.lit(kind).alias(typ),
            _code(prefix, F.col("s_suppkey")).alias(code),
        ),
        schema,
    )


def device_dim(supplier: DataFrame) -> DataFrame:
    return _gadget_dim(supplier, "W", "watch", schemas.D_DEVICE)


def mobile_dim(supplier: DataFrame) -> DataFrame:
    return _gadget_dim(supplier, "P", "phone", schemas.D_MOBILE)


def site_dim(nation: DataFrame) -> DataFrame:
    return schemas.conform_to(
        nation.select((F.col("n_nationkey") + 1).alias("siteid"), F.col("n_name").alias("sitename"),
                      _code("region ", F.col("n_regionkey")).alias("sitelocation")),
        schemas.D_SITE,
    )


def allocation_dim(customer: DataFrame, gadgets: Column, overlap: bool = True) -> DataFrame:
    """One 15-day period per (customer, study); with ``overlap`` every fourth customer
    also has a later, overlapping period at another site (exercises D-2)."""
    study = F.explode(F.array(*[F.lit(i) for i, _ in C.STUDY_SEED])).alias("studyid")
    base = customer.select("c_custkey", "c_nationkey", study)
    start = F.date_add(F.lit(ALLOCATION_BASE_DATE).cast("date"), (F.col("c_custkey") % 10).cast("int"))
    key = F.col("c_custkey")
    primary = base.select(
        ((key * 2 + F.col("studyid")) * 2).alias("allocationid"),
        (key % gadgets + 1).alias("mobileid"),
        (F.col("c_nationkey") + 1).alias("siteid"),
        F.col("studyid"),
        (key + 1).alias("subjectid"),
        (key % gadgets + 1).alias("deviceid"),
        start.alias("startdate"),
        F.date_add(start, 14).alias("enddate"),
    )
    out = primary
    if overlap:
        extra = base.filter(key % 4 == 0).select(
            ((key * 2 + F.col("studyid")) * 2 + 1).alias("allocationid"),
            (key % gadgets + 1).alias("mobileid"),
            ((F.col("c_nationkey") + 1) % 25 + 1).alias("siteid"),
            F.col("studyid"),
            (key + 1).alias("subjectid"),
            (key % gadgets + 1).alias("deviceid"),
            F.date_add(start, 7).alias("startdate"),
            F.date_add(start, 20).alias("enddate"),
        )
        out = primary.unionByName(extra)
    return schemas.conform_to(out, schemas.D_ALLOCATION)


def calendar_dim(events: DataFrame) -> DataFrame:
    """Every hour of the months the events span; timeid counts hours from the first one."""
    bounds = events.agg(
        F.date_trunc("month", F.min("ts")).cast("timestamp").alias("lo"),
        (F.date_trunc("month", F.max("ts")).cast("timestamp") + F.expr("INTERVAL 1 MONTH")
         - F.expr("INTERVAL 1 HOUR")).alias("hi"),
    )
    return calendar_between(bounds)


def study_dims(spark: SparkSession, sf_dir: str, overlap: bool = True) -> Dims:
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    return Dims(
        d_subject=subject_dim(customer),
        d_study=study_dim(spark),
        d_device=device_dim(supplier),
        d_mobile=mobile_dim(supplier),
        d_sensor=sensor_dim(spark),
        d_eventtype=eventtype_dim(spark),
        d_aggtype=aggtype_dim(spark),
        d_site=site_dim(table(spark, sf_dir, "nation")),
        d_allocation=allocation_dim(customer, gadget_count(supplier), overlap),
        d_datetime=calendar_dim(table(spark, sf_dir, "events")),
    )


def study_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records(table(spark, sf_dir, "events"), gadget_count(table(spark, sf_dir, "supplier")))
