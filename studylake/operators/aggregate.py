"""Hourly sensor groups (A-2..A-4, P-9, P-10, P-14) and their re-aggregation over history (J-11, R-3).

A batch's passive rows are grouped per (type, study, subject, watch, phone,
year, month, day, hour).  Counts come from the batch; the heart-rate mean of
a group comes from **all** readings of that group, so a late reading re-opens
its hour and the mean is recomputed.  There are two ways to the same mean:

* :func:`merged_hours`, used by the load: each batch leaves (sum, count) of
  every heart-rate group it met (:func:`hour_partials`, the table
  ``hour_state``), and a late batch adds its own to those of its hours.  The
  refine history is not read.
* :func:`affected_hours`, over the refine history itself.  Batch rows (weight 1,
  no value) and the history rows of the batch's hours (weight 0, with value)
  are unioned and grouped once.  History is cut to the batch's hours by a
  semi-join; to read only their folders, take the history from
  :func:`studylake.sources.zone_index.read_hours`.

The source system ran one Spark job per heart-rate group.  Here either way is
one aggregation.  The grouping handles NULL codes natively (no text matching),
and partial aggregation collapses a hot group before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake import constants as C
from studylake.dims import Dims
from studylake.functions.times import capture_date_of_hour

HOUR_COLS = [C.YEAR_P, C.MONTH_P, C.DAY_P, C.HOUR_P]


def passive_rows(refine: DataFrame) -> DataFrame:
    """P-9: every type but the two event types (a NULL type is excluded too)."""
    return refine.filter(~F.col(C.TYPE_P).isin(*C.EVENT_TYPES))


def hourly_counts(refine: DataFrame) -> DataFrame:
    """A-2: record count per hourly group of the batch."""
    return passive_rows(refine).groupBy(*C.HOUR_GROUP_KEYS).agg(F.count(F.lit(1)).alias("rec_count"))


def hourly_heart_rate(refine: DataFrame) -> DataFrame:
    """A-3 / P-10: mean heart rate per hourly group over the given rows."""
    hr = refine.filter(F.col(C.TYPE_P) == C.HEART_RATE)
    return hr.groupBy(*C.HOUR_GROUP_KEYS).agg(F.avg(C.HEART_BEAT).alias("mean_hr"),
                                              F.count(F.lit(1)).alias("rec_count"))


def in_batch_hours(history: DataFrame, delta: DataFrame) -> DataFrame:
    """History rows of the hours that the batch touches (null-safe: an hour with a NULL part matches its like)."""
    wanted = delta.select(*[F.col(c).alias(f"__{c}") for c in HOUR_COLS]).distinct()
    cond = F.lit(True)
    for c in HOUR_COLS:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return history.join(wanted, cond, "left_semi")


def affected_hours(delta: DataFrame, history: DataFrame | None, dims: Dims | None = None) -> DataFrame:
    """J-11: hourly groups of the batch with ``rec_count`` (batch rows) and ``mean_hr``
    (heart-rate mean over history; over the batch itself when ``history`` is None)."""
    d = passive_rows(delta)
    batch = d.select(*C.HOUR_GROUP_KEYS, F.lit(1).alias("_w"),
                     (F.col(C.HEART_BEAT) if history is None else F.lit(None).cast("double")).alias("_hb"))
    parts = batch
    if history is not None:
        h = history.filter(F.col(C.TYPE_P) == C.HEART_RATE)
        if dims is not None:
            h = in_batch_hours(h, d)
        parts = batch.unionByName(h.select(*C.HOUR_GROUP_KEYS, F.lit(0).alias("_w"), F.col(C.HEART_BEAT).alias("_hb")))
    return (parts.groupBy(*C.HOUR_GROUP_KEYS)
            .agg(F.sum("_w").alias("rec_count"), F.avg("_hb").alias("mean_hr"))
            .filter(F.col("rec_count") > 0)
            .withColumn("rec_count", F.col("rec_count").cast("long")))


def hour_partials(refine: DataFrame) -> DataFrame:
    """R-3: mergeable state of the heart-rate groups of some rows: (group, state_date, hb_sum, hb_count).
    Groups without a measurement add nothing and leave no row."""
    hr = refine.filter((F.col(C.TYPE_P) == C.HEART_RATE) & F.col(C.HEART_BEAT).isNotNull())
    return (hr.groupBy(*C.HOUR_GROUP_KEYS).agg(F.sum(C.HEART_BEAT).alias("hb_sum"), F.count(C.HEART_BEAT).alias("hb_count"))
            .withColumn("state_date", capture_date_of_hour()))


def partials_before(history: DataFrame, delta: DataFrame) -> DataFrame:
    """State of the history rows that are not of ``delta``, which history contains: partials are subtracted, no rows compared."""
    minus = hour_partials(delta).withColumns({"hb_sum": -F.col("hb_sum"), "hb_count": -F.col("hb_count")})
    return (hour_partials(history).unionByName(minus).groupBy(*C.HOUR_GROUP_KEYS, "state_date")
            .agg(F.sum("hb_sum").alias("hb_sum"), F.sum("hb_count").alias("hb_count")).filter(F.col("hb_count") > 0))


def hour_sums(delta: DataFrame) -> DataFrame:
    """A-2 and R-3 in one pass over a batch: per hourly group ``rec_count`` and the batch's own (hb_sum, hb_count)."""
    beat = F.when(F.col(C.TYPE_P) == C.HEART_RATE, F.col(C.HEART_BEAT))
    return passive_rows(delta).groupBy(*C.HOUR_GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("rec_count"), F.sum(beat).alias("hb_sum"), F.count(beat).alias("hb_count"))


def partials_of(sums: DataFrame) -> DataFrame:
    """:func:`hour_partials` of a batch from its :func:`hour_sums`."""
    hr = sums.filter((F.col(C.TYPE_P) == C.HEART_RATE) & (F.col("hb_count") > 0))
    return hr.select(*C.HOUR_GROUP_KEYS, "hb_sum", "hb_count").withColumn("state_date", capture_date_of_hour())


def merged_hours(delta: DataFrame, state: DataFrame) -> DataFrame:
    """J-11 from stored state: as :func:`affected_hours`, with ``state`` the partials of all *other* batches."""
    return merged_sums(hour_sums(delta), state)


def groups_with_state(groups: DataFrame, state: DataFrame) -> DataFrame:
    """Known hourly groups (keys, ``rec_count``), such as rejected ones, with the mean of all that ``state`` holds of them."""
    own = groups.select(*C.HOUR_GROUP_KEYS, "rec_count", F.lit(None).cast("double").alias("hb_sum"), F.lit(0).cast("long").alias("hb_count"))
    return merged_sums(own, state)


def merged_sums(batch: DataFrame, state: DataFrame) -> DataFrame:
    """:func:`merged_hours` of a batch's :func:`hour_sums`."""
    before = state.select(*C.HOUR_GROUP_KEYS, F.lit(0).cast("long").alias("rec_count"), "hb_sum", "hb_count")
    return (batch.unionByName(before).groupBy(*C.HOUR_GROUP_KEYS)
            .agg(F.sum("rec_count").alias("rec_count"), F.sum("hb_sum").alias("hb_sum"), F.sum("hb_count").alias("hb_count"))
            .filter(F.col("rec_count") > 0)
            .select(*C.HOUR_GROUP_KEYS, "rec_count", (F.col("hb_sum") / F.nullif(F.col("hb_count"), F.lit(0))).alias("mean_hr")))


def passive_value(type_col: str = C.TYPE_P) -> F.Column:
    """P-14 / A-4: heart rate -> mean; accelerometer / gyro -> 1 when the hour has records; else 0."""
    t = F.col(type_col)
    return (F.when(t == C.HEART_RATE, F.col("mean_hr"))
            .when(t.isin(*C.EXISTENCE_SENSORS), F.when(F.col("rec_count") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(F.lit(0.0)))


def aggregation_type_name(type_col: str = C.TYPE_P) -> F.Column:
    """P-13: accelerometer and gyro are 'Existence', every other sensor 'Average'."""
    return F.when(F.col(type_col).isin(*C.EXISTENCE_SENSORS), F.lit(C.AGG_EXISTENCE)).otherwise(F.lit(C.AGG_AVERAGE))
