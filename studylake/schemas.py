"""Declared schemas of every zone and table (P-17).

Declaring the raw schema up front removes the inference pass over the JSON,
lets the same plan run as a stream, and fixes the types the source system left
to inference.  Partition columns are declared too, so that a subject code such
as ``007`` is read back as text and not re-typed to an int.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake import constants as C

S, I, L, D, TS, DT = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW = _struct(
    (C.DATA_TYPE, S), (C.STUDY_TYPE, S), (C.SUBJECT_ID, S), (C.DEVICE_MODEL, S),
    (C.PHONE_ID, S), (C.WATCH_ID, S), (C.SOURCE_TYPE, S), (C.SYSTEM_NAME, S), (C.SYSTEM_VERSION, S),
    (C.MEASUREMENT_TIME, S),
    (C.X_ACC, D), (C.Y_ACC, D), (C.Z_ACC, D),
    (C.X_GYRO, D), (C.Y_GYRO, D), (C.Z_GYRO, D),
    (C.HEART_BEAT, D), (C.ADDED_TO_HEALTH, S), (C.DATA_SYNC, S),
    (C.ADDED_TO_HEALTH_MS, L), (C.DATA_SYNC_MS, L),
    (C.START_TIME, S), (C.STOP_TIME, S), (C.SEVERITY, S),
    (C.CORRUPT, S), (C.REST, T.MapType(S, S)),
)

RAW_COLUMNS = [f.name for f in RAW.fields if f.name not in (C.CORRUPT, C.REST)]
TIME_COLUMNS = (C.MEASUREMENT_TIME, C.START_TIME, C.STOP_TIME)

# Refine zone: raw columns (times parsed), calendar columns, partition copies.
REFINE = _struct(
    *[(f.name, TS if f.name in TIME_COLUMNS else f.dataType) for f in RAW.fields if f.name != C.CORRUPT],
    (C.YEAR, I), (C.MONTH, I), (C.DAY, I), (C.HOUR, I),
    (C.TYPE_P, S), (C.YEAR_P, I), (C.MONTH_P, I), (C.DAY_P, I), (C.HOUR_P, I),
)

CONFORM = _struct(
    *[(f.name, f.dataType) for f in REFINE.fields if f.name != C.HOUR_P],
    (C.STUDY_P, S), (C.SUBJECT_P, S),
)

# Dimensions.
D_SITE = _struct(("siteid", I), ("sitename", S), ("sitelocation", S))
D_SUBJECT = _struct(("subjectid", I), ("subjectdesc", S), ("subject_uniquecd", S))
D_MOBILE = _struct(("mobileid", I), ("mobilename", S), ("mobiletype", S), ("mobileuniqcd", S), ("version", S))
D_DEVICE = _struct(("deviceid", I), ("devicename", S), ("devicetype", S), ("deviceuniqcd", S), ("version", S))
D_SENSOR = _struct(("sensorid", I), ("sensorname", S))
D_STUDY = _struct(("studyid", I), ("studyname", S), ("studydesc", S), ("startdate", DT), ("enddate", DT), ("studymgr", S))
D_DATETIME = _struct(("timeid", I), ("year", I), ("month", I), ("date", I), ("hour", I), ("min", I))
D_ALLOCATION = _struct(
    ("allocationid", I), ("mobileid", I), ("siteid", I), ("studyid", I), ("subjectid", I), ("deviceid", I),
    ("startdate", DT), ("enddate", DT),
)
D_EVENTTYPE = _struct(("evtypid", I), ("evtypname", S))
D_AGGTYPE = _struct(("aggtypid", I), ("aggtypename", S))

# Facts.  The generated keys are deterministic hashes of the business key (D-12).
F_INTENTIONAL = _struct(
    ("eventid", L), ("evtypid", I), ("studyid", I), ("siteid", I), ("subjectid", I), ("deviceid", I),
    ("mobileid", I), ("starttimestamp", TS), ("endtimestamp", TS), ("value", I), ("capture_date", DT),
)
F_PASSIVE = _struct(
    ("obsid", L), ("aggtypid", I), ("sensorid", I), ("deviceid", I), ("subjectid", I), ("siteid", I),
    ("studyid", I), ("timeid", I), ("mobileid", I), ("agg_value", D), ("capture_date", DT),
)
# Partial heart-rate sums per hour group and load batch (R-3), kept per capture day.
HOUR_STATE = _struct(*[(c, REFINE[c].dataType) for c in C.HOUR_GROUP_KEYS], (C.LOAD_BATCH, S), ("hb_sum", D), ("hb_count", L),
                     ("state_date", DT))
# Reference-shaped allocation error table, and our row-level reject account.
ALLOCATION_ERRORS = _struct(("mobileid", I), ("studyid", I), ("subjectid", I), ("deviceid", I), ("reccount", L))
REJECTS = _struct(
    ("stage", S), ("reject_reason", S), ("mobileid", I), ("studyid", I), ("subjectid", I), ("deviceid", I),
    ("source_records", L), ("group_id", S),
)
PARTIAL_REJECTS = T.StructType([*REJECTS.fields, T.StructField("n", L)])
REJECT_SUMMARY = _struct(
    ("stage", S), ("reject_reason", S), ("mobileid", I), ("studyid", I), ("subjectid", I), ("deviceid", I),
    ("reccount", L), ("source_records", L),
)

# Rejected rows, kept as JSON of their stage's schema: raw records, refine rows of events, hourly groups.
HOUR_GROUP = _struct(*[(c, REFINE[c].dataType) for c in C.HOUR_GROUP_KEYS], ("rec_count", L))
QUARANTINE = _struct(("stage", S), ("reject_reason", S), ("row", S), (C.SOURCE_FILE, S), (C.LOAD_BATCH, S))

DIMENSIONS: dict[str, T.StructType] = {
    "d_site": D_SITE, "d_subject": D_SUBJECT, "d_mobile": D_MOBILE, "d_device": D_DEVICE,
    "d_sensor": D_SENSOR, "d_study": D_STUDY, "d_datetime": D_DATETIME, "d_allocation": D_ALLOCATION,
    "d_eventtype": D_EVENTTYPE, "d_aggtype": D_AGGTYPE,
}
FACTS: dict[str, T.StructType] = {
    "f_intentional": F_INTENTIONAL, "f_passive": F_PASSIVE,
    "temp_allocation_error_records": ALLOCATION_ERRORS, "rejects": REJECT_SUMMARY,
}
# Primary keys (C-1) and foreign keys (C-2) of the star schema.
PRIMARY_KEYS = {
    "d_site": ["siteid"], "d_subject": ["subjectid"], "d_mobile": ["mobileid"], "d_device": ["deviceid"],
    "d_sensor": ["sensorid"], "d_study": ["studyid"], "d_datetime": ["timeid"], "d_allocation": ["allocationid"],
    "d_eventtype": ["evtypid"], "d_aggtype": ["aggtypid"], "f_passive": list(C.PASSIVE_KEYS),
}
FOREIGN_KEYS = {
    "d_allocation": [("mobileid", "d_mobile"), ("siteid", "d_site"), ("studyid", "d_study"),
                     ("subjectid", "d_subject"), ("deviceid", "d_device")],
    "f_intentional": [("evtypid", "d_eventtype"), ("studyid", "d_study"), ("siteid", "d_site"),
                      ("subjectid", "d_subject"), ("deviceid", "d_device"), ("mobileid", "d_mobile")],
    "f_passive": [("aggtypid", "d_aggtype"), ("sensorid", "d_sensor"), ("deviceid", "d_device"),
                  ("subjectid", "d_subject"), ("siteid", "d_site"), ("studyid", "d_study"),
                  ("timeid", "d_datetime"), ("mobileid", "d_mobile")],
}


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, add absent ones as typed nulls (P-11, P-17)."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
