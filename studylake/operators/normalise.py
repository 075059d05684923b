"""Raw records -> refine rows (P-1..P-6, P-11, D-4, D-6, D-8).

One plan serves every record type: per-type column pruning is a ``CASE`` per
column instead of one filtered copy of the input per type, so the raw input
is scanned once whatever types a batch holds.  Rows that cannot be loaded
carry a ``reject_reason`` instead of vanishing or failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake import constants as C
from studylake import schemas
from studylake.functions.times import calendar_parts, parse_raw_time

REJECT_REASON = "reject_reason"
RAW_ROW = "raw_row"
EVENT_TIME = "__event_time"


def _kept_by(drop_lists: dict[str, list[str]]) -> dict[str, list[str]]:
    """For each column some type drops: the types that keep it."""
    droppable = sorted({c for cols in drop_lists.values() for c in cols})
    return {c: [t for t in drop_lists if c not in drop_lists[t]] for c in droppable}


def prune_by_type(df: DataFrame, drop_lists: dict[str, list[str]] = C.DROP_COLUMNS) -> DataFrame:
    """Null the columns a row's type drops (P-2); other types keep all columns."""
    dt = F.col(C.DATA_TYPE)
    listed = list(drop_lists)
    out = []
    kept = _kept_by(drop_lists)
    for c in df.columns:
        if c in kept:
            out.append(F.when(dt.isin(*kept[c]) | ~dt.isin(*listed) | dt.isNull(), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def normalise(raw: DataFrame) -> DataFrame:
    """Raw records (RAW schema, missing columns allowed) -> REFINE columns + ``reject_reason``.

    Fields that no schema declares go along in ``rest``.  Rejected rows keep
    their raw record as JSON (``raw_row``) and its file, if known.
    Accepted rows have ``reject_reason`` NULL.  Rejected: ``corrupt_record``
    (the JSON line did not parse), ``unknown_type`` (NULL or unlisted type),
    ``bad_timestamp`` (the row's time did not parse).
    """
    source = F.col(C.SOURCE_FILE) if C.SOURCE_FILE in raw.columns else F.lit(None).cast("string")
    names = schemas.RAW.fieldNames()
    raw = schemas.conform_to(raw.withColumn(C.SOURCE_FILE, source), T.StructType([*schemas.RAW.fields, T.StructField(C.SOURCE_FILE, T.StringType())]))
    dt = F.col(C.DATA_TYPE)
    own_text = F.when(dt.isin(*C.SENSOR_TYPES), F.col(C.MEASUREMENT_TIME)).when(dt.isin(*C.EVENT_TYPES), F.col(C.START_TIME))
    # The row's own time is parsed once: a filter on it is not pushed below the generator, where it would
    # repeat the parsing and all that makes the text.
    timed = raw.withColumn(RAW_ROW, F.struct(*names)).select("*", F.explode(F.array(F.struct(parse_raw_time(own_text).alias("t")))).alias(EVENT_TIME))
    event_time = F.col(EVENT_TIME)["t"]
    pruned = prune_by_type(timed)
    own_of = {C.MEASUREMENT_TIME: C.SENSOR_TYPES, C.START_TIME: C.EVENT_TYPES}
    parsed = pruned.withColumns({
        c: F.when(dt.isin(*own_of[c]), event_time).otherwise(parse_raw_time(c)) if c in own_of else parse_raw_time(c) for c in schemas.TIME_COLUMNS})
    with_cal = parsed.withColumns(calendar_parts(event_time))
    with_parts = with_cal.withColumns({
        C.TYPE_P: dt, C.YEAR_P: F.col(C.YEAR), C.MONTH_P: F.col(C.MONTH), C.DAY_P: F.col(C.DAY), C.HOUR_P: F.col(C.HOUR),
    })
    reason = (F.when(F.col(C.CORRUPT).isNotNull(), F.lit(C.R_CORRUPT))
              .when(dt.isNull() | ~dt.isin(*C.ALL_TYPES), F.lit(C.R_UNKNOWN_TYPE))
              .when(event_time.isNull(), F.lit(C.R_BAD_TIMESTAMP)))
    out = with_parts.withColumn(REJECT_REASON, reason)
    return out.select(*[f.name for f in schemas.REFINE.fields], REJECT_REASON, C.CORRUPT, C.SOURCE_FILE,
                      F.when(F.col(REJECT_REASON).isNotNull(), F.to_json(RAW_ROW)).alias(RAW_ROW))


def accepted(normalised: DataFrame) -> DataFrame:
    """Rows that load, in the REFINE schema (P-1 routing: listed types with a time)."""
    return normalised.filter(F.col(REJECT_REASON).isNull()).select(*[f.name for f in schemas.REFINE.fields])


def rejected(normalised: DataFrame) -> DataFrame:
    return normalised.filter(F.col(REJECT_REASON).isNotNull())


def refine_partitions(df: DataFrame) -> DataFrame:
    """Partition copies for the refine zone (P-5); idempotent."""
    return df.withColumns({
        C.TYPE_P: F.col(C.DATA_TYPE), C.YEAR_P: F.col(C.YEAR), C.MONTH_P: F.col(C.MONTH),
        C.DAY_P: F.col(C.DAY), C.HOUR_P: F.col(C.HOUR),
    })


def conform_partitions(refine: DataFrame) -> DataFrame:
    """Refine rows -> conform rows: study and subject copies, no hour copy (P-6)."""
    return refine.withColumns({C.STUDY_P: F.col(C.STUDY_TYPE), C.SUBJECT_P: F.col(C.SUBJECT_ID)}).drop(C.HOUR_P)


def legacy_type_frames(raw: DataFrame) -> DataFrame:
    """The older three-type job's routing (P-1, P-2 with its own drop lists; no time columns)."""
    raw = schemas.conform_to(raw, schemas.RAW)
    return prune_by_type(raw.filter(F.col(C.DATA_TYPE).isin(*C.LEGACY_DROP_COLUMNS)), C.LEGACY_DROP_COLUMNS)
