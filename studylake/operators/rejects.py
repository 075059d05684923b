"""Reject accounting (M-6, U-1, A-5, D-7).

Row-level rejects of every stage are unioned and grouped per (stage, reason,
mobile, study, subject, device).  ``reccount`` counts rejected rows of the
stage (events, or hourly groups for sensors); ``source_records`` counts the
raw records behind them.  :func:`allocation_errors` gives the source system's
table: allocation misses only, merged over stages, ``reccount = count(*)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas

ID_COLS = C.ALLOCATION_KEYS
PARTIAL_KEYS = ["stage", "reject_reason", *ID_COLS, "group_id"]


def group_id() -> F.Column:
    """One text per hourly group (to_json keeps the names of the fields, so a NULL code cannot change places with its neighbour)."""
    return F.sha2(F.to_json(F.struct(*C.HOUR_GROUP_KEYS)), 256)


def accepted_groups(resolved: DataFrame) -> DataFrame:
    """group_id of the hourly groups that load."""
    return resolved.filter(F.col("reject_reason").isNull()).select(group_id().alias("group_id")).distinct()


def reject_rows(resolved: DataFrame, stage: str, records_col: str | None = None) -> DataFrame:
    """Rejected rows of a resolved frame in the REJECTS shape."""
    r = resolved.filter(F.col("reject_reason").isNotNull())
    present = set(r.columns)
    # An hourly group is one reject however many micro-batches of a run it meets.
    group = group_id() if records_col else F.lit(None).cast("string")
    return r.select(
        F.lit(stage).alias("stage"), F.col("reject_reason"),
        *[(F.col(c) if c in present else F.lit(None)).cast("int").alias(c) for c in ID_COLS],
        (F.col(records_col).cast("long") if records_col else F.lit(1).cast("long")).alias("source_records"),
        group.alias("group_id"),
    )


def partial_rejects(rows: DataFrame) -> DataFrame:
    """Row-level rejects counted per (stage, reason, ids, hourly group): what a micro-batch leaves
    for the summary of its run.  ``n`` counts the rows (one per hourly group)."""
    return rows.groupBy(*PARTIAL_KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("source_records").alias("source_records"))


def _net(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*PARTIAL_KEYS).agg(F.sum("n").alias("n"), F.sum("source_records").alias("source_records")).filter(F.col("n") > 0)


def retractions(before: DataFrame, accepted: DataFrame) -> DataFrame:
    """Signed counts that withdraw the rejects of hourly groups (``before``: the run's partial counts so far) that
    have become acceptable, as by a measurement that came with a later micro-batch."""
    known = _net(before.filter(F.col("group_id").isNotNull()))
    return (known.join(accepted, "group_id", "left_semi")
            .withColumns({"n": -F.col("n"), "source_records": -F.col("source_records")}))


def merge_partials(partials: DataFrame) -> DataFrame:
    """The run's REJECT_SUMMARY from the signed partial counts of its micro-batches.  Rows add up; an
    hourly group met by several micro-batches counts once, one that was withdrawn not at all."""
    p = _net(partials).withColumn("n", F.when(F.col("group_id").isNull(), F.col("n")).otherwise(F.lit(1)))
    out = p.groupBy("stage", "reject_reason", *ID_COLS).agg(
        F.sum("n").alias("reccount"), F.sum("source_records").alias("source_records"))
    return schemas.conform_to(out, schemas.REJECT_SUMMARY)


def summary_allocation_errors(summary: DataFrame) -> DataFrame:
    """:func:`allocation_errors` from a run's summary: allocation misses per ids."""
    out = (summary.filter(F.col("reject_reason") == C.R_NO_ALLOCATION)
           .groupBy(*ID_COLS).agg(F.sum("reccount").alias("reccount")))
    return schemas.conform_to(out, schemas.ALLOCATION_ERRORS)


def summarise_rejects(*row_rejects: DataFrame) -> DataFrame:
    """U-1 + A-5: one row per (stage, reason, ids)."""
    u = reduce(lambda a, b: a.unionByName(b), row_rejects)
    out = u.groupBy("stage", "reject_reason", *ID_COLS).agg(
        F.count(F.lit(1)).alias("reccount"), F.sum("source_records").alias("source_records"))
    return schemas.conform_to(out, schemas.REJECT_SUMMARY)


def allocation_errors(row_rejects: DataFrame) -> DataFrame:
    """The source system's reject table: allocation misses per ids, ``reccount = count(*)``."""
    out = (row_rejects.filter(F.col("reject_reason") == C.R_NO_ALLOCATION)
           .groupBy(*ID_COLS).agg(F.count(F.lit(1)).alias("reccount")))
    return schemas.conform_to(out, schemas.ALLOCATION_ERRORS)


def quarantine_rows(resolved: DataFrame, stage: str) -> DataFrame:
    """Rejected rows of a stage, whole, in the QUARANTINE shape (D-6, C-3): raw records of ``refine``, refine rows of
    ``event``, hourly groups of ``passive``."""
    r = resolved.filter(F.col("reject_reason").isNotNull())
    if stage == "refine":
        row, source = F.col("raw_row"), F.col(C.SOURCE_FILE)
    else:
        schema = schemas.REFINE if stage == "event" else schemas.HOUR_GROUP
        row, source = F.to_json(F.struct(*schema.fieldNames())), F.lit(None).cast("string")
    return r.select(F.lit(stage).alias("stage"), "reject_reason", row.alias("row"), source.alias(C.SOURCE_FILE))


def rows_of_stage(quarantine: DataFrame, stage: str) -> DataFrame:
    """The rows that :func:`quarantine_rows` kept, as they were."""
    schema = {"refine": schemas.RAW, "event": schemas.REFINE, "passive": schemas.HOUR_GROUP}[stage]
    kept = quarantine.filter(F.col("stage") == stage)
    return kept.select(F.from_json("row", schema).alias("r"), C.SOURCE_FILE).select("r.*", C.SOURCE_FILE)
