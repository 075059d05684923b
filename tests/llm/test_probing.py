"""Multiprobe hashing: the buckets visited, recall and the share of points looked at, odd tables."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from studylake.llm import ann_multiprobe as ann


def unit(rng: np.random.Generator, n: int, dim: int) -> np.ndarray:
    x = rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_normal_distribution_function():
    z = np.linspace(-6, 6, 401)
    assert np.allclose(ann.normal_cdf(z), [math.erfc(-x / math.sqrt(2)) / 2 for x in z], atol=2e-7)
    assert ann.normal_cdf(np.array([-np.inf, np.inf])).tolist() == [0, 1]


@pytest.mark.parametrize("least", [-2.0, 0.0, 1.0, 99.0])
def test_probes_are_all_buckets_of_the_least_ratio(least):
    h = ann.Hashes(12, 4, tables=3)
    q = unit(np.random.default_rng(1), 6, 12)
    gain = h.gains(q, 0.5)
    row, key = h.probes(q, ann.Probing(4, 0.5, least))
    got = sorted(zip(row.tolist(), key.tolist()))
    cells = list(itertools.product(range(len(h.cell)), repeat=4))
    want = []
    for i in range(len(q)):
        for c in cells:
            keys = h.keys(np.broadcast_to(np.array(c), (1, 3, 4)))[0]
            want += [(i, int(keys[t])) for t in range(3) if sum(gain[i, t, m, c[m]] for m in range(4)) >= least]
    assert got == sorted(want)


def test_ratios_are_those_of_random_neighbours():
    """The model's chance of a cell equals its frequency among random neighbours of that cosine."""
    rng = np.random.default_rng(3)
    dim, cosine, h = 48, 0.6, ann.Hashes(48, 3, tables=400)
    q = unit(rng, 1, dim)
    other = rng.normal(size=dim)
    other -= (other @ q[0]) * q[0]
    near = cosine * q + math.sqrt(1 - cosine ** 2) * (other / np.linalg.norm(other))[None]
    mean = cosine * h.places(q)[0][..., None]
    chance = np.diff(ann.normal_cdf((h.edges - mean) / 0.8), axis=-1)
    assert abs(np.take_along_axis(chance, h.cells(near)[0][..., None], -1).mean() - (chance ** 2).sum(-1).mean()) < 0.05


def test_recall_and_share_of_points(spark):
    rng = np.random.default_rng(4)
    shares = {}
    for n in (1000, 8000):
        x = unit(rng, n, 24)
        frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
        got = ann.search(frame, F.col("vec_id") % 50 == 0).collect()
        asked = np.arange(0, n, 50)
        near = x[asked] @ x.T
        near[np.arange(len(asked)), asked] = -2
        least = np.sort(near, axis=1)[:, -5]
        assert sum(r["score"] >= least[r["query_id"] // 50] - 1e-9 for r in got) >= 0.9 * 5 * len(asked)
        rows = frame.select(F.array("vec_id").alias("ids"), F.col("embedding").alias("v"))
        to = ann.fit(rows, rows.where("ids[0] % 50 = 0"), n, 5)
        h = ann.Hashes(24, to.hashes)
        keys, (row, probe) = h.keys(h.cells(x)), h.probes(x[asked], to)
        shares[n] = np.mean([np.isin(keys, probe[row == i]).any(axis=1).mean() for i in range(len(asked))])
    assert shares[8000] < shares[1000] and shares[8000] < 0.4


def test_mixed_lengths_infinities_repeats_and_queries_without_candidates(spark, monkeypatch):
    ran = []
    plain = ann._against_all
    monkeypatch.setattr(ann, "_against_all", lambda short, points, n, k: ran.append(n) or plain(short, points, n, k))
    rng = np.random.default_rng(5)
    x, y = unit(rng, 300, 16), unit(rng, 4, 5)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + 50 * i, v.tolist()) for i, v in enumerate(y)]
    rows += [(1, x[0].tolist()), (1, x[0].tolist()), (2000, [math.inf] + [1.0] * 15), (2050, []), (2100, None)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1)).withColumn("bin", F.lit("x"))
    found: dict[int, list] = {}
    for r in ann.search(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(found) == [*range(0, 300, 50), 1000, 1050, 1100, 1150]
    assert found[0][0][0] == 1 and abs(found[0][0][1] - 1) < 1e-12  # an id that repeats with another vector
    near = y @ y.T
    for i in range(4):  # three other vectors of that length: all are given, by an exact scan
        best = found[1000 + 50 * i]
        want = sorted((-near[i, j], 1000 + 50 * j) for j in range(4) if j != i)
        assert [v for v, _ in best] == [v for _, v in want] and np.allclose([s for _, s in best], [-s for s, _ in want])
    assert len(ran) == 2 and ran[1] >= 4  # the fit, then the queries that found too few
