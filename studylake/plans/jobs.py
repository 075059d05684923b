"""The three jobs, each a handful of DataFrame plans (M-1, M-2, M-3).

Routing, key resolution, interval validation, re-aggregation, upsert and reject
accounting are joins and aggregations that run on the executors.  The driver
holds row counts and the lists of the folders to read (from the tables'
manifests; see ``sinks/snapshots.py``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas
from studylake.dims import Dims
from studylake.operators import facts
from studylake.operators.aggregate import groups_with_state, hour_sums, merged_sums, partials_before, partials_of
from studylake.operators.allocation import settled
from studylake.operators.normalise import accepted, normalise, rejected
from studylake.operators.rejects import (accepted_groups, merge_partials, partial_rejects, quarantine_rows, reject_rows, rows_of_stage,
                                         summary_allocation_errors)
from studylake.sinks import warehouse
from studylake.sinks.snapshots import SnapshotTable
from studylake.sinks.zones import write_conform, write_refine
from studylake.sources.zones import read_refine


@dataclass
class ZonePaths:
    refine: str
    conform: str


@dataclass
class Refined:
    """One refined batch: accepted refine rows, row-level rejects of the stage, and the
    counts (records, accepted, rejected); ``bad`` holds the rejects whole, for the quarantine.  The frames
    read the persisted ``batch``."""
    accepted: DataFrame
    rejects: DataFrame
    bad: DataFrame
    batch: DataFrame
    metrics: dict[str, int] = field(default_factory=dict)

    def unpersist(self) -> None:
        self.batch.unpersist(blocking=True)


def refine_and_conform(spark: SparkSession, raw: DataFrame, zones: ZonePaths,
                       batch_tag: str | None = None) -> Refined:
    """M-1: normalise a raw batch once and write refine and conform from it.

    The caller unpersists the result; a failed write frees the batch itself.
    The batch is normalised once
    (MEMORY_AND_DISK): both writes read the persisted rows, so raw is scanned
    once per run; a lost block is recomputed from the raw files.
    """
    n = normalise(raw)
    n = n.persist(StorageLevel.MEMORY_AND_DISK)
    acc = accepted(n)
    try:
        # A-6: row counts of the run.  They fill the persisted batch that both writes read; metrics
        # observed by a write are lost when adaptive execution empties its plan.
        counts = n.agg(F.count(F.lit(1)).alias("records"),
                       F.count(F.when(F.col("reject_reason").isNull(), 1)).alias("accepted"),
                       F.count(F.col("reject_reason")).alias("rejected")).first().asDict()
        write_refine(acc, zones.refine, batch_tag)
        write_conform(acc, zones.conform, batch_tag)
    except BaseException:
        n.unpersist(blocking=True)
        raise
    return Refined(acc, reject_rows(rejected(n), "refine"), quarantine_rows(rejected(n), "refine"), n, counts)


def init_warehouse(spark: SparkSession, root: str, dims: Dims) -> dict[str, str]:
    """M-2: create the warehouse tables and load the dimensions."""
    return warehouse.init_warehouse(spark, root, dims)


def load_facts(spark: SparkSession, delta: DataFrame, history: DataFrame | None, dims: Dims, root: str,
               extra_rejects: DataFrame | None = None, append_only: bool = False,
               run: warehouse.RunRejects | None = None, batch_tag: str | None = None,
               bad: DataFrame | None = None, quarantine: str = warehouse.QUARANTINE) -> dict[str, DataFrame]:
    """M-3: refine batch -> event fact (append), hourly fact (upsert), reject tables (overwrite).

    Heart-rate means of the batch's hours are taken over all readings loaded so far: the partial sums that
    earlier batches left in the warehouse's ``hour_state`` plus the batch's own, which it leaves there in turn.
    ``history`` (the refine zone including ``delta``) is read once in a warehouse's life: the first load puts
    what the zone held before it into the state.  Without it the state starts empty.

    ``batch_tag`` names the batch: a replay under the same tag replaces its own partial sums.  With ``run`` the
    batch is one micro-batch of a run, and the reject tables hold the run's rejects so far; without, they hold
    the batch's.  The rejected rows themselves, with ``bad`` of the stage before, are kept in the table
    ``quarantine`` (see :func:`replay_quarantine`).
    """
    with settled(dims):
        return _load_facts(spark, delta, history, dims, root, extra_rejects, append_only, run, batch_tag or uuid.uuid4().hex, bad, quarantine)


def _load_facts(spark: SparkSession, delta: DataFrame, history: DataFrame | None, dims: Dims, root: str, extra_rejects: DataFrame | None,
                append_only: bool, run: warehouse.RunRejects | None, tag: str, bad: DataFrame | None, quarantine: str) -> dict[str, DataFrame]:
    if history is not None and not warehouse.snapshots(spark, root, warehouse.STATE).exists():
        warehouse.add_state(spark, root, partials_before(history, delta), "before")
    ev = facts.resolve_events(delta, dims).persist(StorageLevel.MEMORY_AND_DISK)
    # all that the hourly fact and the state need of the batch, so its rows are read once for them
    sums = hour_sums(schemas.conform_to(delta, schemas.REFINE)).persist(StorageLevel.MEMORY_AND_DISK)
    pv = None
    try:
        state = warehouse.other_state(spark, root, sums, tag)
        pv = facts.resolve_groups(merged_sums(sums, state), dims).persist(StorageLevel.MEMORY_AND_DISK)
        warehouse.append_events(spark, root, facts.event_fact(ev), dedup=not append_only)
        warehouse.upsert_passive(spark, root, facts.passive_fact(pv))
        warehouse.add_state(spark, root, partials_of(sums), tag)
        rows = reject_rows(ev, "event").unionByName(reject_rows(pv, "passive", "rec_count"))
        if extra_rejects is not None:
            rows = rows.unionByName(extra_rejects)
        kept = quarantine_rows(ev, "event").unionByName(quarantine_rows(pv, "passive"))
        warehouse.keep_rejected(spark, root, kept if bad is None else kept.unionByName(bad), tag, quarantine)
        partials = partial_rejects(rows)
        summary = merge_partials(partials) if run is None else run.summary(partials, tag, accepted_groups(pv))
        warehouse.overwrite_table(root, "rejects", summary)
        warehouse.overwrite_table(root, "temp_allocation_error_records",
                                  summary_allocation_errors(warehouse.read_table(spark, root, "rejects")))
    finally:
        ev.unpersist(blocking=True)
        sums.unpersist(blocking=True)
        if pv is not None:
            pv.unpersist(blocking=True)
    return {name: warehouse.read_table(spark, root, name)
            for name in ("f_intentional", "f_passive", "rejects", "temp_allocation_error_records")}


def run_batch(spark: SparkSession, raw: DataFrame, zones: ZonePaths, dims: Dims, root: str,
              append_only: bool = False, batch_tag: str | None = None,
              run: warehouse.RunRejects | None = None,
              quarantine: str = warehouse.QUARANTINE) -> dict[str, DataFrame] | None:
    """M-1 then M-3 for one raw batch; an empty batch writes nothing (S-5).

    ``batch_tag`` (incremental loads) makes the zone writes replay-safe; see
    :func:`studylake.sinks.zones.write_refine`.  A zone is written either with
    tags (incremental) or without (batch appends), not both.
    """
    if raw.isEmpty():
        return None
    refined = refine_and_conform(spark, raw, zones, batch_tag)
    try:
        history = read_refine(spark, zones.refine)
        return load_facts(spark, refined.accepted, history, dims, root, refined.rejects, append_only, run, batch_tag,
                          refined.bad, quarantine)
    finally:
        refined.unpersist()


def replay_quarantine(spark: SparkSession, zones: ZonePaths, dims: Dims, root: str,
                      mend: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """D-6, C-3: load the rejected rows again, once a dimension or a rule is mended.

    Raw records go through M-1 and M-3 (after ``mend``, if given), events and hourly groups through M-3.  What
    loads reaches the facts once: a replay that broke off runs under the same batch tag again, events are
    anti-joined, hours are upserted.  What is still rejected stays in the quarantine, which the last step replaces.
    """
    table = warehouse.snapshots(spark, root, warehouse.QUARANTINE)
    if not table.exists():
        return
    tag = f"replay-{table.newest()}"  # the number changes with the last step only
    rows = table.read()
    raw = rows_of_stage(rows, "refine")
    following = warehouse.snapshots(spark, root, warehouse.QUARANTINE_NEXT)
    following.drop()
    with settled(dims):
        _replay(spark, rows, raw, zones, dims, root, mend, tag, table, following)


def _replay(spark: SparkSession, rows: DataFrame, raw: DataFrame, zones: ZonePaths, dims: Dims, root: str, mend: Callable[[DataFrame], DataFrame] | None,
            tag: str, table: SnapshotTable, following: SnapshotTable) -> None:
    run_batch(spark, mend(raw) if mend else raw, zones, dims, root, batch_tag=tag, quarantine=warehouse.QUARANTINE_NEXT)
    ev = facts.resolve_events(rows_of_stage(rows, "event"), dims).persist(StorageLevel.MEMORY_AND_DISK)
    groups = rows_of_stage(rows, "passive").groupBy(*C.HOUR_GROUP_KEYS).agg(F.sum("rec_count").alias("rec_count"))
    pv = None
    try:
        state = warehouse.state_of(spark, root, groups)
        pv = facts.resolve_groups(groups_with_state(groups, state), dims).persist(StorageLevel.MEMORY_AND_DISK)
        warehouse.append_events(spark, root, facts.event_fact(ev))
        warehouse.upsert_passive(spark, root, facts.passive_fact(pv))
        still = quarantine_rows(ev, "event").unionByName(quarantine_rows(pv, "passive")).withColumn(C.LOAD_BATCH, F.lit(tag))
        if following.exists():
            still = still.unionByName(following.read())
        table.overwrite(schemas.conform_to(still, schemas.QUARANTINE))
    finally:
        ev.unpersist(blocking=True)
        if pv is not None:
            pv.unpersist(blocking=True)
