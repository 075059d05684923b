"""Bounded training samples of labelled documents, and models trained in one task on them."""

from __future__ import annotations

import io
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on at most (the rows with the smallest key hashes).
MAX_TRAIN_ROWS = 20_000
#: Characters of text over all of them at most, a bound on the training task's memory.
MAX_TRAIN_CHARS = 200_000_000


def remainder(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 5 (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % 5


def training_rows(documents: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, n_chars, label) of at most ``max_rows`` labelled rows whose remainder is not 0.

    The choice is by hash of the id, so it does not depend on order.  An id
    with several labels takes the largest; null ids, labels and texts do not
    take part.  The chosen ids are at most ``max_rows``, so broadcasting them
    is bounded.
    """
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (remainder(F.col("doc_id")) != 0))
           .groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    have = documents.select("doc_id", "text", *[F.col(c).cast("double").alias(c) for c in documents.columns if c == "n_chars"])
    if "n_chars" not in documents.columns:
        have = have.withColumn("n_chars", F.lit(None).cast("double"))
    return have.where("text is not null").join(F.broadcast(ids), "doc_id")


def fit_in_task(rows: DataFrame, fit: Callable[[pa.Table], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """``fit`` applied to all ``rows`` (a bounded sample) in one task; returns the arrays of the model."""

    def run(batches):
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.Table.from_batches(tables)
        t = t.take(pa.compute.sort_indices(t, sort_keys=[("doc_id", "ascending"), ("label", "ascending"), ("n_chars", "ascending")]))
        out = io.BytesIO()
        np.savez(out, **fit(t))
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["model"])

    got = rows.repartition(1).mapInArrow(run, "model binary").collect()
    if not got:
        return {}
    with np.load(io.BytesIO(got[0]["model"])) as z:
        return {k: z[k] for k in z.files}
