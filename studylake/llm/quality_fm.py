"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score(x) = w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j, and the pair sum is
computed in linear time as half of |sum v_i x_i|^2 - sum |v_i x_i|^2.
Features of a text: its distinct word buckets (weights 1/sqrt of their number),
one bin of every structure statistic, and one bin of the metadata n_chars.
Labels, lang, source and doc_id are no inputs.

The model is fitted on a bounded sample of labelled rows (``labelled.py``)
whose crc32 remainder is not 0; every whole text is scored, in place, without
a shuffle.

Edge cases: null text scores as empty text; empty texts get a score; null
n_chars is its own bin; a null doc_id is held out as null and scored; repeated
rows are scored one by one; without labelled rows every score is 0.5; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm.common import small_batches, table
from studylake.llm.features import STATS, Texts
from studylake.llm.labelled import MAX_TRAIN_ROWS, fit_in_task, remainder, training_rows

BITS = 14
BINS = 12
RANK = 6
EPOCHS = 8
#: A small sample is gone through more often, until this many rows have been visited.
VISITS = 60_000
BATCH = 64
RATE = 0.08
DECAY = 1e-5
WORD_WEIGHT = 0.5
KEEP_FROM = 0.3

N_WORDS = 1 << BITS
N_FEATURES = N_WORDS + len(STATS) * (BINS + 1)


def sparse_rows(texts: Texts, n_chars: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, value, first): features of text i are first[i]:first[i + 1].  ``n_chars`` is NaN where null."""
    bucket, _, first = texts.hashed_words(BITS)
    n_words = np.diff(first)
    stats = texts.stats(n_chars)
    bins = np.empty(stats.shape, dtype=np.int64)
    for k in range(len(STATS)):
        bins[:, k] = N_WORDS + k * (BINS + 1) + np.searchsorted(cuts[k], stats[:, k], side="right")
    bins[np.isnan(n_chars), -1] = N_WORDS + len(STATS) * (BINS + 1) - 1
    at = np.repeat(first[1:], len(STATS))
    feature = np.insert(bucket, at, bins.ravel())
    value = np.insert(WORD_WEIGHT / np.sqrt(np.repeat(np.maximum(n_words, 1), n_words)), at, 1.0)
    return feature, value, first + len(STATS) * np.arange(texts.n + 1)


def _sums(v: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(v, first[:-1], axis=0)  # no row is empty: each has its statistics


def logits(model: dict, feature: np.ndarray, value: np.ndarray, first: np.ndarray) -> np.ndarray:
    vx = model["v"][feature] * value[:, None]
    return (model["w0"][0] + _sums(model["w"][feature] * value, first)
            + 0.5 * ((_sums(vx, first) ** 2).sum(1) - _sums((vx ** 2).sum(1), first)))


def fit(sample: pa.Table) -> dict[str, np.ndarray]:
    """AdaGrad on the log loss, over the whole (bounded) sample."""
    y = sample["label"].to_numpy()
    n_chars = sample["n_chars"].to_numpy()
    parts, stats = [], []
    for lo in range(0, len(y), 1000):
        t = Texts(sample["text"].slice(lo, 1000))
        parts.append((t, n_chars[lo:lo + 1000]))
        stats.append(t.stats(n_chars[lo:lo + 1000]))
    # bins: the same number of sample rows in each, for the share of values that differ
    cuts = np.quantile(np.concatenate(stats), np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
    rows = [sparse_rows(t, c, cuts) for t, c in parts]
    base = np.cumsum([0] + [r[2][-1] for r in rows])
    feature = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    first = np.concatenate([r[2][:-1] + b for r, b in zip(rows, base, strict=False)] + [[base[-1]]])
    del parts, rows, stats
    rng = np.random.default_rng(7)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = {"w0": np.array([np.log(share / (1 - share))]), "w": np.zeros(N_FEATURES), "v": rng.normal(0, 0.03, (N_FEATURES, RANK)), "cuts": cuts}
    gw, gv, g0 = np.full(N_FEATURES, 1e-3), np.full((N_FEATURES, RANK), 1e-3), 1e-3
    for _ in range(max(EPOCHS, -(-VISITS // len(y)))):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            pick = order[lo:lo + BATCH]
            size = first[pick + 1] - first[pick]
            own = np.repeat(np.arange(len(pick)), size)
            start = np.cumsum(size) - size
            at = np.arange(size.sum()) - start[own] + first[pick][own]
            f, x = feature[at], value[at]
            edge = np.r_[start, size.sum()]
            p = 1 / (1 + np.exp(-np.clip(logits(model, f, x, edge), -30, 30)))
            err = (p - y[pick]) / len(pick)
            used, back = np.unique(f, return_inverse=True)
            vx = model["v"][f] * x[:, None]
            total = _sums(vx, edge)
            ex = err[own] * x
            grad = np.bincount(back, ex, len(used)) + DECAY * model["w"][used]
            gw[used] += grad ** 2
            model["w"][used] -= RATE * grad / np.sqrt(gw[used])
            inner = ex[:, None] * (total[own] - vx)
            for r in range(RANK):
                grad = np.bincount(back, inner[:, r], len(used)) + DECAY * model["v"][used, r]
                gv[used, r] += grad ** 2
                model["v"][used, r] -= RATE * grad / np.sqrt(gv[used, r])
            g0 += err.sum() ** 2
            model["w0"] -= RATE * err.sum() / np.sqrt(g0)
    return model


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> dict[str, np.ndarray]:
    small_batches(documents.sparkSession)
    return fit_in_task(training_rows(documents, labels, "quality", max_rows), fit)


def score(documents: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``documents`` (any columns, with text and perhaps n_chars) and a new column quality_score."""
    small_batches(documents.sparkSession)
    name = "quality_score"
    source = documents.drop(name)
    has_chars = "n_chars" in source.columns

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            if model:
                n_chars = b.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False) if has_chars else np.full(b.num_rows, np.nan)
                out = np.empty(b.num_rows)
                for lo in range(0, b.num_rows, 250):
                    t = Texts(b.column("text").slice(lo, 250))
                    out[lo:lo + 250] = 1 / (1 + np.exp(-np.clip(logits(model, *sparse_rows(t, n_chars[lo:lo + 250], model["cuts"])), -30, 30)))
            else:
                out = np.full(b.num_rows, 0.5)
            yield b.append_column(name, pa.array(out))

    return source.mapInArrow(run, source.withColumn(name, F.lit(0.0)).schema)


def op5_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = score(documents, train(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= KEEP_FROM).cast("int").alias("predicted"))
