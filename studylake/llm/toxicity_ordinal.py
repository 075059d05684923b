"""Toxicity: cumulative-link ordinal regression on sparse text features.

P(grade >= k | x) = 1 / (1 + exp(theta_k - w.x)) with one weight vector w for
all thresholds theta_1 < theta_2 < theta_3, and the expected severity is the
sum of these over k.  Features are words and word prefixes (3 to 8 bytes) that
toxic training rows hold far more often than the rest, valued by
1 + log2(count), at most 3.

Labels say only toxic or not.  So a training row's grade is 0 if it is not
toxic; toxic rows are cut into grades 1 to 3 at the terciles of the evidence
in them: the summed log odds of their features, by square root of the words.

The model is fitted on a bounded sample of labelled rows (``labelled.py``);
every whole text is scored in place, without a shuffle.

Edge cases: null and empty texts have no features, which scores as not toxic;
without toxic or without other labels the severity is 0 for all; null ids and
repeated rows are scored one by one; an empty table gives an empty result;
other columns are kept by ``severity``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from studylake.llm.common import _BYTE, _U, NOT_ALPHANUMERIC, mix, small_batches, string_buffers, table, words
from studylake.llm.labelled import MAX_TRAIN_ROWS, fit_in_task, training_rows

GRADES = 3
PREFIXES = range(3, 9)
#: Features that the model keeps at most, the lift and the share of toxic rows that they need.
MAX_FEATURES, MIN_LIFT, MIN_SHARE, MIN_ROWS = 4096, 6.0, 0.02, 5
STEPS, RATE, SHRINK = 400, 0.1, 1e-3
FILTER_BITS = 20
TOXIC_FROM = 0.4


def features(column) -> tuple[np.ndarray, np.ndarray, int]:
    """(feature hash, text) of every word and word prefix, and the number of texts."""
    data, off = string_buffers(pc.utf8_lower(column))
    h, start, end, first = words(data, off, NOT_ALPHANUMERIC)
    text = np.repeat(np.arange(len(off) - 1), np.diff(first))
    found, owner = [mix(h ^ _U(0x77))], [text]
    acc = np.zeros(len(h), dtype=_U)
    for k in range(max(PREFIXES)):
        long = end - start > k
        start, end, acc, text = start[long], end[long], acc[long], text[long]
        acc = (acc ^ (acc >> _U(31))) * _U(0x9FB21C651E98DF25) + _BYTE[data[start + k]]
        if k + 1 in PREFIXES:
            longer = end - start > k + 1  # a word that is the prefix itself is a feature of its own
            found.append(mix(acc[longer] + _U(k + 1)))
            owner.append(text[longer])
    return np.concatenate(found), np.concatenate(owner), len(off) - 1


class Known:
    """Exact look-up of feature hashes in a sorted set."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(hashes >> _U(64 - FILTER_BITS)).astype(np.int64)] = True

    def counts(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(text, feature index, count) of the known features in the texts, and the number of texts."""
        f, text, n = features(column)
        some = np.flatnonzero(self.filter[(f >> _U(64 - FILTER_BITS)).astype(np.int64)])
        if not len(self.hashes) or not len(some):
            e = np.zeros(0, dtype=np.int64)
            return e, e, e, n
        at = np.minimum(np.searchsorted(self.hashes, f[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == f[some]
        key, count = np.unique(text[some[hit]].astype(np.int64) * len(self.hashes) + at[hit], return_counts=True)
        return key // len(self.hashes), key % len(self.hashes), count, n


def _slices(column, size: int = 500):
    for lo in range(0, len(column), size):
        yield lo, column.slice(lo, size)


def _chosen(texts, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, log odds) of the features that set toxic rows apart."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    least = max(MIN_ROWS, int(np.ceil(MIN_SHARE * n1)))
    bad, good = texts.filter(pa.array(toxic)), texts.filter(pa.array(~toxic))
    seen = []
    for _, part in _slices(bad):
        f, text, _ = features(part)
        o = np.lexsort((f, text))
        f, text = f[o], text[o]
        new = np.ones(len(f), dtype=bool)
        new[1:] = (f[1:] != f[:-1]) | (text[1:] != text[:-1])
        seen.append(np.unique(f[new], return_counts=True))
    f = np.concatenate([a for a, _ in seen])
    hashes, back = np.unique(f, return_inverse=True)
    with_1 = np.bincount(back, np.concatenate([b for _, b in seen]))
    hashes, with_1 = hashes[with_1 >= least], with_1[with_1 >= least]
    known, with_0 = Known(hashes), np.zeros(len(hashes))
    for _, part in _slices(good):
        with_0 += np.bincount(known.counts(part)[1], minlength=len(hashes))
    odds = np.log((with_1 + 0.1) / (n1 + 0.2)) - np.log((with_0 + 0.5) / (n0 + 1))
    rank = np.argsort(-odds * with_1, kind="stable")
    rank = np.sort(rank[odds[rank] >= np.log(MIN_LIFT)][:MAX_FEATURES])
    return hashes[rank], odds[rank]


def _value(count: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.log2(np.maximum(count, 1)), 3.0)


def fit(sample: pa.Table) -> dict[str, np.ndarray]:
    texts = sample["text"].combine_chunks()
    toxic = sample["label"].to_numpy() >= 0.5
    if toxic.all() or not toxic.any():
        return {"hashes": np.zeros(0, dtype=_U), "w": np.zeros(0), "theta": np.full(GRADES, np.inf)}
    hashes, odds = _chosen(texts, toxic)
    known = Known(hashes)
    parts = [(lo, known.counts(part)) for lo, part in _slices(texts)]
    text = np.concatenate([lo + c[0] for lo, c in parts])
    feature = np.concatenate([c[1] for _, c in parts])
    value = _value(np.concatenate([c[2] for _, c in parts]))
    n = len(toxic)
    length = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    evidence = np.bincount(text, value * odds[feature], n) / np.sqrt(1 + length / 100)
    grade = np.where(toxic, 1 + np.searchsorted(np.quantile(evidence[toxic], [1 / 3, 2 / 3]), evidence, side="left"), 0)
    w, gap, theta = np.zeros(len(hashes)), np.zeros(GRADES - 1), float(np.log((~toxic).sum() / toxic.sum()))
    at_least = grade[:, None] >= np.arange(1, GRADES + 1)
    state = [np.zeros_like(w), np.zeros_like(gap), 0.0, np.zeros_like(w), np.zeros_like(gap), 0.0]
    for step in range(1, STEPS + 1):  # Adam on the log likelihood of the grades
        eta = np.bincount(text, value * w[feature], n)
        th = theta + np.r_[0, np.cumsum(np.exp(gap))]
        p = 1 / (1 + np.exp(np.clip(th - eta[:, None], -40, 40)))  # P(grade >= k)
        upper = np.column_stack([np.ones(n), p])
        lower = np.column_stack([p, np.zeros(n)])
        like = np.maximum(upper[np.arange(n), grade] - lower[np.arange(n), grade], 1e-12)
        slope = p * (1 - p)
        # d log likelihood / d (eta - theta_k): the edge above the row's grade is k = grade + 1, the edge below k = grade
        d = np.zeros((n, GRADES))
        k = np.arange(GRADES)
        d += np.where(grade[:, None] == k + 1, slope, 0) / like[:, None]
        d -= np.where(grade[:, None] == k, slope, 0) / like[:, None]
        g_eta = d.sum(1)
        g_th = -d.sum(0) / n
        grads = [np.bincount(feature, value * g_eta[text], len(w)) / n - SHRINK * w / np.sqrt(n), np.exp(gap) * np.cumsum(g_th[::-1])[::-1][1:], g_th.sum()]
        moved = []
        for i, g in enumerate(grads):
            state[i] = 0.9 * state[i] + 0.1 * g
            state[3 + i] = 0.99 * state[3 + i] + 0.01 * g * g
            moved.append(RATE * (state[i] / (1 - 0.9 ** step)) / (np.sqrt(state[3 + i] / (1 - 0.99 ** step)) + 1e-8))
        w, gap, theta = w + moved[0], gap + moved[1], theta + moved[2]
    assert at_least.shape == p.shape
    return {"hashes": hashes, "w": w, "theta": theta + np.r_[0, np.cumsum(np.exp(gap))]}


def exceed(model: dict, column) -> np.ndarray:
    """P(grade >= k) of every text, k = 1.. in columns."""
    text, feature, count, n = model["known"].counts(column)
    eta = np.bincount(text, _value(count) * model["w"][feature], n)
    return 1 / (1 + np.exp(np.clip(model["theta"] - eta[:, None], -40, 40)))


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> dict[str, np.ndarray]:
    small_batches(documents.sparkSession)
    return fit_in_task(training_rows(documents, labels, "toxic", max_rows), fit)


def severity(documents: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``documents`` (any columns, with text) and expected_severity (0 to 3), grade (the likeliest), toxic (1 if P(grade >= 1) reaches TOXIC_FROM)."""
    small_batches(documents.sparkSession)
    source = documents.drop("expected_severity", "grade", "toxic")
    schema = StructType(list(source.schema.fields)).add("expected_severity", DoubleType()).add("grade", IntegerType()).add("toxic", IntegerType())

    def run(batches):
        own = {**model, "known": Known(model["hashes"])} if model else None
        for b in batches:
            p = np.zeros((b.num_rows, GRADES))
            if own is not None and np.isfinite(own["theta"]).all():
                for lo, part in _slices(b.column("text"), 250):
                    p[lo:lo + 250] = exceed(own, part)
            of = np.column_stack([np.ones(len(p)), p]) - np.column_stack([p, np.zeros(len(p))])
            yield (b.append_column("expected_severity", pa.array(p.sum(1))).append_column("grade", pa.array(of.argmax(1).astype(np.int32)))
                   .append_column("toxic", pa.array((p[:, 0] >= TOXIC_FROM).astype(np.int32))))

    return source.mapInArrow(run, schema)


def op2_ordinal_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return severity(documents, train(documents, table(spark, sf_dir, "labels"))).select("doc_id", "expected_severity", "grade", "toxic")
