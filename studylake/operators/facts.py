"""Fact builds (M-4 event fact, M-5 passive fact) as single DataFrame plans.

Each returns the resolved rows with a ``reject_reason`` (NULL = loads);
:func:`studylake.operators.allocation.split` separates them.  Reject reasons,
first match wins: ``no_allocation`` (site 0: the rows the source system
counted as allocation errors), then ``unknown_event_type`` / ``bad_severity``
for events and ``unknown_time`` / ``unknown_sensor`` / ``no_measurement`` for
sensor hours (the source system lost or failed on these).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas
from studylake.dims import Dims
from studylake.functions.times import capture_date_of_hour
from studylake.operators.aggregate import affected_hours, aggregation_type_name, merged_hours, passive_value
from studylake.operators.allocation import allocate_site
from studylake.operators.lookups import resolve_codes, resolve_time

EVENT_KEY = ["evtypid", "studyid", "subjectid", "deviceid", "mobileid", "starttimestamp", "endtimestamp", "value"]


def event_rows(refine: DataFrame) -> DataFrame:
    """P-8: the participant-reported event types."""
    return refine.filter(F.col(C.TYPE_P).isin(*C.EVENT_TYPES))


def event_value() -> F.Column:
    """P-12: meal -> -1; migraine -> severity as int (NULL when not an integer)."""
    return (F.when(F.col(C.TYPE_P) == C.MIGRAINE, F.expr(f"try_cast(trim({C.SEVERITY}) as int)"))
            .otherwise(F.lit(C.MEAL_EVENT_VALUE)))


EVENT_DIMS = ["d_eventtype", "d_study", "d_subject", "d_device", "d_mobile", "d_allocation"]
EVENT_CODES = [C.TYPE_P, C.STUDY_TYPE, C.SUBJECT_ID, C.WATCH_ID, C.PHONE_ID, "capture_date"]
EVENT_IDS = ["evtypid", "studyid", "subjectid", "deviceid", "mobileid"]
PASSIVE_DIMS = ["d_sensor", "d_aggtype", "d_study", "d_subject", "d_device", "d_mobile", "d_allocation"]
PASSIVE_CODES = [C.TYPE_P, "aggtypename", C.STUDY_TYPE, C.SUBJECT_ID, C.WATCH_ID, C.PHONE_ID, "capture_date"]
PASSIVE_IDS = ["sensorid", "aggtypid", "studyid", "subjectid", "deviceid", "mobileid"]


def resolve_by_combination(df: DataFrame, dims: Dims, codes: list[str], ids: list[str],
                           date_col: str = "capture_date") -> DataFrame:
    """Ids and site of each row, resolved once per distinct ``codes`` combination and joined back.

    Used when a dimension is over the broadcast bound: the lookups then shuffle
    the distinct combinations (partially aggregated, far fewer than the rows)
    instead of every row once per dimension, and the rows are shuffled at most
    once, for the null-safe join back (AQE may broadcast the combinations, and
    splits a hot combination's partition).
    """
    keys = df.select(*codes).distinct()
    keys = allocate_site(resolve_codes(keys, dims, ids), dims, date_col)
    k = keys.select(*[F.col(c).alias(f"__k_{c}") for c in codes], *ids, "siteid")
    cond = None
    for c in codes:
        e = F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        cond = e if cond is None else cond & e
    return df.join(k, cond, "left").drop(*[f"__k_{c}" for c in codes])


def resolve_events(refine: DataFrame, dims: Dims) -> DataFrame:
    """M-4 without the write: event rows with ids, site, value and a reject reason.

    With every dimension under the broadcast bound, the lookups and the
    allocation join are broadcast joins on the event rows (no shuffle);
    otherwise see :func:`resolve_by_combination`.
    """
    ev = event_rows(schemas.conform_to(refine, schemas.REFINE))  # P-11: a missing severity is a typed NULL
    ev = ev.withColumn("value", event_value()).withColumn("capture_date", F.to_date(C.START_TIME))
    bounded = dims.check_bounds(EVENT_DIMS)
    if all(bounded[d] for d in EVENT_DIMS):
        ev = allocate_site(resolve_codes(ev, dims, EVENT_IDS), dims, "capture_date")
    else:
        ev = resolve_by_combination(ev, dims, EVENT_CODES, EVENT_IDS)
    reason = (F.when(F.col("siteid") == 0, F.lit(C.R_NO_ALLOCATION))
              .when(F.col("evtypid") == 0, F.lit(C.R_UNKNOWN_EVENT_TYPE))
              .when(F.col("value").isNull(), F.lit(C.R_BAD_SEVERITY)))
    ev = ev.withColumns({
        "starttimestamp": F.col(C.START_TIME), "endtimestamp": F.col(C.STOP_TIME),
        "reject_reason": reason,
    })
    # Deterministic surrogate key of the business columns (D-12); identity checks use the columns.
    return ev.withColumn("eventid", F.xxhash64(*EVENT_KEY))


def event_fact(resolved: DataFrame) -> DataFrame:
    return schemas.conform_to(resolved.filter(F.col("reject_reason").isNull()), schemas.F_INTENTIONAL)


def resolve_passive(delta: DataFrame, dims: Dims, history: DataFrame | None = None, state: DataFrame | None = None) -> DataFrame:
    """M-5 without the write: hourly groups with ids, time, site, value and a reject reason.

    The heart-rate means of the batch's hours are taken over ``state`` (partial sums of other batches, see
    :func:`studylake.operators.aggregate.merged_hours`) or over ``history`` (the refine zone including ``delta``);
    with neither, the batch is the whole history.
    """
    delta = schemas.conform_to(delta, schemas.REFINE)
    if state is not None:
        groups = merged_hours(delta, state)
    else:
        groups = affected_hours(delta, None if history is None else schemas.conform_to(history, schemas.REFINE), dims)
    return resolve_groups(groups, dims)


def resolve_groups(groups: DataFrame, dims: Dims) -> DataFrame:
    """Hourly groups (keys, ``rec_count``, ``mean_hr``) with ids, time, site, value and a reject reason."""
    g = groups.withColumns({
        "agg_value": passive_value(),
        "aggtypename": aggregation_type_name(),
        "capture_date": capture_date_of_hour(),
    })
    bounded = dims.check_bounds([*PASSIVE_DIMS, "d_datetime"])
    if all(bounded[d] for d in PASSIVE_DIMS):
        g = allocate_site(resolve_codes(g, dims, PASSIVE_IDS), dims, "capture_date")
    else:
        g = resolve_by_combination(g, dims, PASSIVE_CODES, PASSIVE_IDS)
    g = resolve_time(g, dims)
    reason = (F.when(F.col("siteid") == 0, F.lit(C.R_NO_ALLOCATION))
              .when(F.col("timeid") == 0, F.lit(C.R_UNKNOWN_TIME))
              .when(F.col("sensorid") == 0, F.lit(C.R_UNKNOWN_SENSOR))
              .when(F.col("agg_value").isNull(), F.lit(C.R_NO_MEASUREMENT)))
    return g.withColumn("reject_reason", reason).withColumn("obsid", F.xxhash64(*C.PASSIVE_KEYS))


def passive_fact(resolved: DataFrame) -> DataFrame:
    return schemas.conform_to(resolved.filter(F.col("reject_reason").isNull()), schemas.F_PASSIVE)
