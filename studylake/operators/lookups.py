"""Code -> surrogate key resolution (J-1..J-8, A-7, P-16, T-1, T-2).

Each lookup is a left equi-join against the dimension reduced to one id per
code (the highest id wins, as when a code map is built in id order), so a
duplicated code can never multiply fact rows.  A code that does not resolve,
NULL included, maps to id 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake import constants as C
from studylake.dims import Dims
from studylake.functions.columns import code_or_zero

# (fact code column, dimension, dimension code column, dimension id column)
CODE_LOOKUPS = {
    "subjectid": (C.SUBJECT_ID, "d_subject", "subject_uniquecd", "subjectid"),   # J-1
    "studyid": (C.STUDY_TYPE, "d_study", "studyname", "studyid"),                # J-2
    "deviceid": (C.WATCH_ID, "d_device", "deviceuniqcd", "deviceid"),            # J-3
    "mobileid": (C.PHONE_ID, "d_mobile", "mobileuniqcd", "mobileid"),            # J-4
    "sensorid": (C.TYPE_P, "d_sensor", "sensorname", "sensorid"),                # J-5
    "evtypid": (C.TYPE_P, "d_eventtype", "evtypname", "evtypid"),                # J-6
    "aggtypid": ("aggtypename", "d_aggtype", "aggtypename", "aggtypid"),         # J-7
}


def latest_code(dim: DataFrame, code_col: str, id_col: str) -> DataFrame:
    """One row per code, the highest id (A-7).  NULL codes never match, so they are dropped."""
    return dim.filter(F.col(code_col).isNotNull()).groupBy(code_col).agg(F.max(id_col).alias(id_col))


def resolve_code(df: DataFrame, dims: Dims, out: str, code_col: str | None = None) -> DataFrame:
    """Add ``out`` = id of ``df[code_col]`` in its dimension, 0 when unknown."""
    default_code, dim_name, dim_code, dim_id = CODE_LOOKUPS[out]
    code_col = code_col or default_code
    key = f"__{out}_code"
    right = latest_code(getattr(dims, dim_name), dim_code, dim_id).select(
        F.col(dim_code).alias(key), F.col(dim_id).alias(f"__{out}"))
    joined = df.join(dims.side(dim_name, right), F.col(code_col) == F.col(key), "left")
    return joined.withColumn(out, code_or_zero(f"__{out}")).drop(key, f"__{out}")


def resolve_codes(df: DataFrame, dims: Dims, outs: list[str]) -> DataFrame:
    for out in outs:
        df = resolve_code(df, dims, out)
    return df


def resolve_time(df: DataFrame, dims: Dims, year=C.YEAR_P, month=C.MONTH_P, day=C.DAY_P, hour=C.HOUR_P) -> DataFrame:
    """Add ``timeid`` from the calendar on typed (year, month, day, hour) keys, 0 when absent (J-8, D-1)."""
    cal = (dims.d_datetime.groupBy("year", "month", "date", "hour").agg(F.max("timeid").alias("__timeid"))
           .select(F.col("year").alias("__y"), F.col("month").alias("__m"), F.col("date").alias("__d"),
                   F.col("hour").alias("__h"), "__timeid"))
    cond = ((F.col(year) == F.col("__y")) & (F.col(month) == F.col("__m"))
            & (F.col(day) == F.col("__d")) & (F.col(hour) == F.col("__h")))
    joined = df.join(dims.side("d_datetime", cal), cond, "left")
    return joined.withColumn("timeid", code_or_zero("__timeid")).drop("__y", "__m", "__d", "__h", "__timeid")


def preview(dim: DataFrame, id_col: str, n: int = 10) -> DataFrame:
    """First ``n`` rows by id (T-2, T-4): an ordered smoke read instead of an unordered LIMIT."""
    return dim.orderBy(id_col).limit(n)
