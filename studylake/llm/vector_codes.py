"""Vector code compression by ball k-means (operator 13).

A vector becomes integers floor(scale * x), cut into equal consecutive parts.
Every part position has a codebook; a part's code is the index of its nearest
entry (squared Euclidean distance, ties to the lower index).  The codebooks
start as the parts of the smallest vec_ids and move ``ROUNDS`` times to the
componentwise floor(sum / count) of their parts; an unused entry stays.

Ball k-means (Xia et al., 2020), exact in integers.  An entry and its parts
are a ball.  Its squared radius is bounded by the largest distance of the last
assignment and the entry's move since.  Only entries no further than twice the
radius are *neighbours*.  A part at distance d of its entry

* is in the ball's *stable core* and keeps its code when no neighbour lies
  within 2 d;
* else lies in an *annular ring* between two neighbours' half distances, and
  only the neighbours inside the ring (within 2 d, itself included, so that
  ties are seen) are measured.

This holds for any current code.  Before the first round a part's ball is the
nearest of ``PIVOTS`` entries, with every other entry as neighbour.

On Spark, a round is one pass that rewrites the codes beside the integers (a
Parquet table in the shared folder, which cuts the lineage) and one pass that
adds up sums, counts and radii: every task sends one row per component of the
codebooks, whatever its number of vectors.  The driver holds codebooks only,
``ENTRIES`` times the vector length.

Defined results: vectors that are null or empty, hold null or non-finite
components, or components too large for distances in a long (some 2 million at
64 components) take no part.  Nor do vectors whose length is not that of the
kept vector with the smallest vec_id.  Vectors are padded with zeros to a
multiple of ``PARTS``.  Repeated vec_ids are rows of their own (ties by the
vector); a null vec_id comes last.  With fewer than ``ENTRIES`` vectors the
codebooks are as many entries long.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm.common import table, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
PIVOTS = 8
BATCH_ROWS = 16_384
#: Sums over labels are broadcast up to this many labels, joined by a shuffle beyond.
MAX_BROADCAST_LABELS = 100_000


@dataclass(frozen=True)
class Balls:
    """Codebooks and, per ball, its neighbours by rising squared distance (arrays over part and entry)."""
    books: np.ndarray  # parts x entries x width
    near: list[list[np.ndarray]]
    reach: list[list[np.ndarray]]
    pivots: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for v in self.books.reshape(-1).tolist()).encode()).hexdigest()


def _square(x: np.ndarray) -> np.ndarray:
    return np.einsum("...i,...i->...", x, x)


def balls(books: np.ndarray, radius2: np.ndarray | None = None) -> Balls:
    """``radius2``: bound of every ball's squared radius, -1 for a ball without parts; None: no bound known."""
    near, reach = [], []
    for p, book in enumerate(books):
        gap = _square(book[:, None, :] - book[None, :, :])
        near.append([])
        reach.append([])
        for i in range(len(book)):
            order = np.argsort(gap[i], kind="stable")
            order = order[order != i]
            if radius2 is not None:
                order = order[gap[i, order] <= 4 * radius2[p][i]]
            near[p].append(order)
            reach[p].append(gap[i, order])
    n = books.shape[1]
    return Balls(books, near, reach, np.unique(np.linspace(0, n - 1, min(PIVOTS, n)).astype(int)))


def moved(books: np.ndarray, sums: np.ndarray, counts: np.ndarray, radius2: np.ndarray) -> Balls:
    """The codebooks after an update, with neighbours by the balls' radii around the moved entries."""
    new = np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], books)
    shift2 = _square(new - books)
    bound = [[-1 if n == 0 else int(r) + int(s) + 2 * (math.isqrt(int(r) * int(s)) + 1) for n, r, s in zip(*row, strict=True)]
             for row in zip(counts, radius2, shift2, strict=True)]
    return balls(new, np.array(bound, dtype=object))


def nearest(x: np.ndarray, own: np.ndarray, part: int, b: Balls) -> tuple[np.ndarray, np.ndarray]:
    """Exact (code, squared distance) of the parts ``x`` whose current codes are ``own``."""
    book = b.books[part]
    best, best_d = own.copy(), _square(x - book[own])
    order = np.argsort(own, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
        if len(rows) == 0:
            continue
        i = own[rows[0]]
        ring = np.searchsorted(b.reach[part][i], 4 * best_d[rows], side="right")  # 0: stable core
        for t, j in enumerate(b.near[part][i]):
            inside = ring > t
            rows, ring = rows[inside], ring[inside]
            if len(rows) == 0:
                break
            d = _square(x[rows] - book[j])
            better = (d < best_d[rows]) | ((d == best_d[rows]) & (j < best[rows]))
            best[rows[better]], best_d[rows[better]] = j, d[better]
    return best, best_d


def first_guess(x: np.ndarray, part: int, b: Balls) -> np.ndarray:
    pivots = b.books[part][b.pivots]
    return b.pivots[np.argmin(np.stack([_square(x - c) for c in pivots]), axis=0)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BATCH_ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _cut(t: pa.Table, width: int) -> np.ndarray:
    """rows x parts x width."""
    flat = t["ints"].combine_chunks()
    flat = pa.concat_arrays([c.flatten() for c in flat.chunks]) if isinstance(flat, pa.ChunkedArray) else flat.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(t.num_rows, PARTS, width)


def _codes(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["codes"].to_pylist()), dtype=np.uint8).reshape(t.num_rows, PARTS)


def _binary(codes: np.ndarray) -> pa.Array:
    n, size = codes.shape
    offsets = np.arange(0, (n + 1) * size, size, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(codes.tobytes())])


def _assigned(state: DataFrame, b: Balls, carry: list[str], last: bool) -> DataFrame:
    """One assignment of every part; the last one leaves the integers out."""
    width = b.books.shape[2]
    known = "codes" in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches):
            x = _cut(t, width)
            old = _codes(t) if known else None
            codes, error = np.empty((t.num_rows, PARTS), dtype=np.uint8), np.zeros(t.num_rows, dtype=np.int64)
            for p in range(PARTS):
                own = old[:, p].astype(np.int64) if known else first_guess(x[:, p], p, b)
                code, d = nearest(x[:, p], own, p, b)
                codes[:, p] = code
                error += d
            out = {c: t[c].combine_chunks() for c in [*carry, *([] if last else ["ints"])]}
            yield from pa.table({**out, "codes": _binary(codes), "error": pa.array(error)}).to_batches()

    names = [*carry, *([] if last else ["ints"])]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in state.select(*names).schema.fields), "codes binary", "error bigint"])
    return state.mapInArrow(run, schema)


def _totals(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, counts and squared radii of the balls: a row per component from every task, then one aggregate."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, radius2 = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64), np.zeros((parts, entries), np.int64)
        for t in _blocks(batches):
            x, codes = _cut(t, width), _codes(t).astype(np.int64)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], x[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                np.maximum.at(radius2[p], codes[:, p], _square(x[:, p] - books[p][codes[:, p]]))
        p, e, k = np.nonzero(np.broadcast_to(counts[..., None] > 0, books.shape))
        if len(p):
            yield pa.record_batch({"part": pa.array(p.astype(np.int32)), "entry": pa.array(e.astype(np.int32)), "pos": pa.array(k.astype(np.int32)),
                                   "total": pa.array(sums[p, e, k]), "n": pa.array(counts[p, e]), "radius2": pa.array(radius2[p, e])})

    rows = (state.select("ints", "codes").mapInArrow(run, "part int, entry int, pos int, total bigint, n bigint, radius2 bigint")
            .groupBy("part", "entry", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("radius2").alias("radius2")).collect())
    sums, counts, radius2 = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64), np.zeros((parts, entries), np.int64)
    for r in rows:
        sums[r.part, r.entry, r.pos], counts[r.part, r.entry], radius2[r.part, r.entry] = r.total, r.n, r.radius2
    return sums, counts, radius2


def usable(vectors: DataFrame, vec: str) -> DataFrame:
    """Rows whose vector is not null or empty and holds finite components only."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.where(F.col(vec).isNotNull() & (F.size(vec) > 0) & ~bad)


def compress(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding", carry: list[str] | None = None) -> tuple[DataFrame, Balls | None]:
    """(``carry`` columns, codes binary, error long) of every usable row, and the final codebooks (None without rows).

    ``carry`` (default: the id) names the columns to keep; they must not be called ints, codes or error.
    """
    carry = [id_col] if carry is None else carry
    rows = usable(vectors, vec)
    first = rows.orderBy(F.col(id_col).asc_nulls_last(), vec).select(F.size(vec).alias("n")).first()
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.select(*carry).schema.fields), "codes binary", "error bigint"])
    if first is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    width = -(-first.n // PARTS)
    most = math.isqrt((1 << 62) // width) // (2 * SCALE)
    rows = rows.where((F.size(vec) == first.n) & ~F.exists(vec, lambda x: F.abs(x.cast("double")) > most))
    ints = F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    if width * PARTS > first.n:
        ints = F.concat(ints, F.array_repeat(F.lit(0), width * PARTS - first.n))
    state = written(rows.select(*carry, F.col(id_col).alias("__id"), ints.alias("ints")), "vector-ints")
    seeds = state.orderBy(F.col("__id").asc_nulls_last(), "ints").limit(ENTRIES).select("ints").collect()  # ENTRIES rows
    if not seeds:  # every vector of that length holds too large a component
        return vectors.sparkSession.createDataFrame([], schema), None
    state = state.drop("__id")
    books = np.array([r.ints for r in seeds], dtype=np.int64).reshape(len(seeds), PARTS, width).transpose(1, 0, 2).copy()
    b = balls(books)
    for _ in range(ROUNDS):
        state = written(_assigned(state, b, carry, last=False), "vector-codes").drop("error")
        b = moved(b.books, *_totals(state, b.books))
    return _assigned(state, b, carry, last=True), b


def op13_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, b = compress(vectors, carry=["vec_id", "label"])
    coded = written(coded, "vector-coded")
    by_label = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label"), "label-errors")
    side = F.broadcast(by_label) if by_label.count() <= MAX_BROADCAST_LABELS else by_label
    return (coded.join(side, F.col("label").eqNullSafe(F.col("__label")))
            .select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                    F.lit(b.digest() if b else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256")))


def _sql() -> str:
    def assign(i: int) -> str:
        return f"""a{i} AS (
  SELECT rid, p, arg_min(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d FROM (
    SELECT v.rid, v.p, b.entry, list_sum(list_transform(range(1, len(v.part) + 1), lambda k: (v.part[k] - b.part[k]) * (v.part[k] - b.part[k]))) AS d
    FROM parts v JOIN b{i} b ON b.p = v.p) GROUP BY rid, p)"""

    def update(i: int) -> str:
        return f"""u{i} AS (
  SELECT p, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS part FROM (
    SELECT v.p, a.entry, k, CAST(sum(v.part[k]) AS BIGINT) AS s, count(*) AS n
    FROM parts v JOIN a{i} a ON a.rid = v.rid AND a.p = v.p, LATERAL (SELECT unnest(range(1, len(v.part) + 1)) AS k) g
    GROUP BY v.p, a.entry, k) GROUP BY p, entry),
b{i + 1} AS (SELECT b.p, b.entry, COALESCE(u.part, b.part) AS part FROM b{i} b LEFT JOIN u{i} u ON u.p = b.p AND u.entry = b.entry)"""

    rounds = ",\n".join(f"{assign(i)},\n{update(i)}" for i in range(ROUNDS))
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, ints) - 1 AS rid, ints FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0)
),
parts AS (
  SELECT rid, p, ints[p * len(ints) // {PARTS} + 1 : (p + 1) * len(ints) // {PARTS}] AS part
  FROM kept, LATERAL (SELECT unnest(range({PARTS})) AS p) g
),
b0 AS (SELECT p, rid AS entry, part FROM parts WHERE rid < {ENTRIES}),
{rounds},
{assign(ROUNDS)},
coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', a.entry), '' ORDER BY a.p) AS code, CAST(sum(a.d) AS BIGINT) AS error
  FROM kept k JOIN a{ROUNDS} a ON a.rid = k.rid GROUP BY k.rid, k.vec_id, k.label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, entry)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded
"""


SQL = _sql()
