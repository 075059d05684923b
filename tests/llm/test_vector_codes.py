"""Ball k-means against plain k-means over all entries, in integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from studylake.llm import vector_codes as V

ROWS = "vec_id bigint, embedding array<float>, label int"


def plain(vectors: list[tuple[int, list[float], int | None]]) -> tuple[dict, str]:
    """Codes, errors and codebooks with every distance computed; vectors: usable, sorted by id and integers."""
    ints = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v, _ in vectors]
    width = -(-len(ints[0]) // V.PARTS)
    ints = [v + [0] * (width * V.PARTS - len(v)) for v in ints]
    order = sorted(range(len(ints)), key=lambda i: (vectors[i][0] is None, vectors[i][0] or 0, ints[i]))
    parts = [[v[p * width:(p + 1) * width] for v in ints] for p in range(V.PARTS)]
    books = [[parts[p][i] for i in order[:V.ENTRIES]] for p in range(V.PARTS)]

    def assign(p):
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(books[p])) for x in parts[p]]

    for _ in range(V.ROUNDS):
        for p in range(V.PARTS):
            near = assign(p)
            for j in range(len(books[p])):
                own = [x for x, (_, k) in zip(parts[p], near, strict=True) if k == j]
                if own:
                    books[p][j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = [assign(p) for p in range(V.PARTS)]
    out = [(vectors[i][0], "".join(f"{last[p][i][1]:02x}" for p in range(V.PARTS)), sum(last[p][i][0] for p in range(V.PARTS)), vectors[i][2]) for i in range(len(ints))]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def save(spark, folder: str, rows: list) -> None:
    spark.createDataFrame(rows, ROWS).withColumn("codes", F.lit("x")).withColumn("error", F.lit(1)).repartition(3).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")


@pytest.mark.parametrize("n,size,grid", [(300, 32, 3), (40, 16, 100), (120, 20, 4)])
def test_query_equals_plain_k_means(spark, tmp_dir, n, size, grid):
    rng = random.Random(n)
    good = [(rng.choice([None, *range(n)]), [rng.randrange(-grid, grid) / 7 for _ in range(size)], rng.choice([None, 0, 1])) for _ in range(n)]
    good += good[:10]  # repeated rows
    first = min((r for r in good if r[0] is not None), key=lambda r: r[0])
    bad = [(-5, None, 0), (-4, [], 1), (-3, [None] * size, 0), (-2, [float("nan")] * size, 1), (first[0], [*first[1][:-1], float("inf")], 0), (n + 1, [0.5] * (size + 1), 0), (n + 2, [1e30] * size, 1)]
    save(spark, tmp_dir, good + bad)
    want, books = plain(good)
    sums: dict = {}
    for _, _, e, label in want:
        sums[label] = sums.get(label, 0) + e
    got = V.op13_ball_kmeans(spark, tmp_dir).collect()
    none = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=none) == sorted(((i, c, e, sums[label], books) for i, c, e, label in want), key=none)


def test_no_usable_vector_gives_an_empty_result(spark, tmp_dir):
    save(spark, tmp_dir, [(1, None, 0), (2, [], 0)])
    assert V.op13_ball_kmeans(spark, tmp_dir).collect() == []


def test_shuffled_join_of_label_sums_is_the_same(spark, monkeypatch, tmp_dir):
    rng = random.Random(3)
    save(spark, tmp_dir, [(i, [rng.random() for _ in range(16)], rng.choice([None, 1, 2])) for i in range(50)])
    one = sorted(map(tuple, V.op13_ball_kmeans(spark, tmp_dir).collect()))
    monkeypatch.setattr(V, "MAX_BROADCAST_LABELS", 0)
    assert sorted(map(tuple, V.op13_ball_kmeans(spark, tmp_dir).collect())) == one


def test_rings_measure_few_entries_and_lose_none():
    rng = np.random.default_rng(1)
    centres = rng.integers(-5000, 5000, (64, 4))
    own = rng.integers(0, 64, 4000)
    x = centres[own] + rng.integers(-200, 200, (4000, 4))
    gap = lambda a, b: ((a[:, None, :] - b[None]) ** 2).sum(-1)
    d = gap(x, centres)
    radius2 = np.array([d[own == i, i].max(initial=-1) for i in range(64)], dtype=object)
    b = V.balls(centres[None], radius2[None])
    code, error = V.nearest(x, own, 0, b)
    assert (code == d.argmin(1)).all() and (error == d.min(1)).all()
    assert np.mean([len(n) for n in b.near[0]]) < 16  # neighbours of a ball, of 63 entries
    core = [(4 * d[own == i, i] < b.reach[0][i][0]).mean() if len(b.reach[0][i]) else 1.0 for i in range(64)]
    assert np.mean(core) > 0.5  # parts that measure no other entry
