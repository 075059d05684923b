"""Incremental raw -> warehouse load (S-3..S-5, R-1..R-3).

The file source with a checkpoint replaces the job bookmark: each run picks
up exactly the raw files not seen before (``trigger(availableNow=True)``
processes the backlog and stops).  Each micro-batch runs M-1 then M-3 inside
``foreachBatch``.  Late rows are never dropped: the hours they touch are
recomputed from the partial sums of all batches (``hour_state``) and upserted.
No watermark is needed because no streaming state is kept; the state is the
warehouse.

A replayed micro-batch (crash between the writes and the checkpoint commit)
is harmless for the facts: events are anti-joined on their business key, the
hourly fact is an upsert, and the reject tables are summed from one folder per
micro-batch, which a replay overwrites.  The reject tables describe a run: all
micro-batches of an ``availableNow`` run (with those of a run before it that
broke off), or one trigger of a run on a schedule.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from studylake.dims import Dims
from studylake.plans.jobs import ZonePaths, load_facts, run_batch
from studylake.sinks.warehouse import RunRejects
from studylake.sources.raw import stream_raw
from studylake.sources.zones import stream_refine


DEFAULT_MAX_FILES_PER_TRIGGER = 5000
#: Refine files are columns and compressed: a micro-batch of so many bytes is some ten times as large as rows.
DEFAULT_MAX_BYTES_PER_TRIGGER = 64 << 30


def _finish(q, timeout_s: float | None) -> None:
    """Wait for an ``availableNow`` query; a run that hits its time limit is stopped and raises."""
    if q.awaitTermination(timeout_s) is False:
        q.stop()
        raise TimeoutError(f"the run did not finish in {timeout_s} s; the next run goes on from its checkpoint")
    if q.exception() is not None:
        raise q.exception()


def _run_key(checkpoint: str) -> str:
    """A folder name for the load that this checkpoint belongs to."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def run_incremental(spark: SparkSession, raw_dir: str, zones: ZonePaths, dims: Dims, root: str,
                    checkpoint: str, max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                    timeout_s: float | None = None, processing_time: str | None = None):
    """Load every raw file not yet loaded, then stop (one ``availableNow`` run).

    A backlog is split into micro-batches of at most ``max_files_per_trigger``
    files (``availableNow`` honours the limit), so a year of hourly drops is
    not persisted and loaded as one batch; every file is still loaded.

    With ``processing_time`` (e.g. ``"15 minutes"``) the query keeps running and
    loads new drops on that schedule; the running query is returned.
    """

    fallback = uuid.uuid4().hex
    run = RunRejects(spark, root, _run_key(checkpoint))

    def handle(batch: DataFrame, batch_id: int) -> None:
        # The stream's id is kept in its checkpoint, so a replayed micro-batch gets the same tag
        # and overwrites its own zone folders; a new checkpoint gets new tags.
        qid = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or fallback
        if processing_time:  # a trigger on a schedule is a run of its own
            run.begin()
        run_batch(batch.sparkSession, batch, zones, dims.fresh(), root, batch_tag=f"{qid}-{batch_id}", run=run)
        if processing_time:
            run.complete()

    w = (stream_raw(spark, raw_dir, max_files_per_trigger).writeStream
         .foreachBatch(handle)
         .option("checkpointLocation", checkpoint))
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    run.begin()
    q = w.trigger(availableNow=True).start()
    _finish(q, timeout_s)
    run.complete()


def refine_stream(spark: SparkSession, refine_dir: str, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """S-4: the refine zone as a stream of new files (for a separate facts job)."""
    return stream_refine(spark, refine_dir, max_bytes_per_trigger)


def run_incremental_facts(spark: SparkSession, refine_dir: str, dims: Dims, root: str, checkpoint: str,
                          timeout_s: float | None = None,
                          max_bytes_per_trigger: int | None = DEFAULT_MAX_BYTES_PER_TRIGGER) -> None:
    """M-3 on its own schedule: each run loads the facts from refine files written since the last
    run (S-4, R-1), in micro-batches of at most ``max_bytes_per_trigger``; heart-rate means add up over them by
    the warehouse's hourly state (R-3).  :func:`studylake.sources.zones.backlog` tells what is left to do."""

    run_key = _run_key(checkpoint)
    run = RunRejects(spark, root, run_key)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # S-5
            return
        s = batch.sparkSession
        delta = batch.persist()
        try:
            load_facts(s, delta, None, dims.fresh(), root, run=run, batch_tag=f"{run_key}-{batch_id}")
        finally:
            delta.unpersist()

    run.begin()
    q = (refine_stream(spark, refine_dir, max_bytes_per_trigger).writeStream.foreachBatch(handle)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _finish(q, timeout_s)
    run.complete()
