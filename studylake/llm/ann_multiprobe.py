"""Approximate nearest neighbours: multiprobe p-stable hashing.

Unit vectors are hashed by TABLES functions, each of several projections
floor((a.v + b) / WIDTH) with normal a (p-stable for the Euclidean distance,
which orders unit vectors as the cosine does); the outermost cells are open.
The number of projections grows with the logarithm of the points, so that
buckets stay small.

Projections of two unit vectors with cosine c are jointly normal with
correlation c.  So the chance that a query's neighbour lies in a bucket, and
the share of unrelated points there, are products over the projections.  A
query visits its own and the perturbed buckets of all tables in the order of
estimated success per point looked at (the ratio of the two), down to a least
ratio.  Perturbed buckets are found projection by projection; a prefix that no
completion can bring up to the least ratio is left.

c and the least ratio are fitted on the exact neighbours of at most FIT_QUERIES
queries among all points: c is the median cosine, and the ratio is such that
RECALL of these neighbours are met.  This bounds the sample, not the search:
every point is indexed, and a bucket has no cap.

All candidates of a bucket are compared with all queries that visit it by one
matrix product in double precision; what reaches a query's k best so far, less
SLACK for rounding, is scored exactly on the original vectors.

Equal vectors are one point with its smallest ids (one more than the answers
asked for: no other copy can be among them, as ties go to smaller ids), and
equal queries are asked once.  So a vector that a third of all rows share is
one row here.  Points go to bins by bucket; the number of bins grows with the
points, and a query goes only to bins that hold a bucket it visits.  Queries
of a bin come in slices of at most SLICE, each with its own copy of the bin's
points, which stream past in batches.

Queries that found fewer than asked for are run against all points, in blocks.

Edge cases: vectors that are null, zero, or hold null or non-finite components
take no part, and rows without an id neither; only vectors of one length are
compared; repeated rows count once; fewer candidates than asked for give all;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from studylake.llm.common import _U, groups, mix, table, written

TABLES, WIDTH = 16, 1.5
#: Cells that reach beyond so many standard deviations are open.
OPEN_FROM = 1.0
#: Queries of the fit, and the share of their exact neighbours that the fitted ratio must meet.
FIT_QUERIES, RECALL = 96, 0.95
SEED = 20
#: Points (times tables) of a bin, queries of a slice and of a block: they set the size of a task's work, not the result.
BIN_POINTS, SLICE, BLOCK = 49_152, 5_000, 4_096
PIECE, PAIRS, PENDING = 16_384, 50_000, 200_000
SLACK = 1e-9


def usable(v: Column) -> Column:
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))


def normal_cdf(z: np.ndarray) -> np.ndarray:
    """Standard normal distribution function (Abramowitz and Stegun 7.1.26, error under 2e-7)."""
    u = np.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * u)
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-u * u) / 2
    return np.where(z < 0, tail, 1 - tail)


def projections(points: int) -> int:
    """Projections of a table for so many points: log2 over 2.2, at least four (three cells of width 1.5 tell about that many bits apart)."""
    return max(4, round(math.log2(max(points, 1)) / 2.2))


class Probing(NamedTuple):
    """How far a query goes: projections of a table, fitted cosine of neighbours, least log ratio of a visited bucket."""

    hashes: int
    cosine: float
    least: float


class Hashes:
    """The hash functions for vectors of one length."""

    def __init__(self, dim: int, hashes: int, tables: int = TABLES, width: float = WIDTH):
        rng = np.random.default_rng([SEED, dim])
        self.dim, self.tables, self.hashes, self.width = dim, tables, hashes, width
        self.a = rng.normal(size=(dim, tables * hashes))
        self.b = rng.uniform(0, width, (tables, hashes))
        self.last = max(1, math.ceil(OPEN_FROM / width))
        inner = np.arange(1 - self.last, self.last + 1) * width - self.b[..., None]
        self.edges = np.concatenate([np.full((tables, hashes, 1), -np.inf), inner, np.full((tables, hashes, 1), np.inf)], axis=-1)
        self.start = mix(np.arange(tables, dtype=_U) + _U(dim << 16))
        self.cell = np.arange(2 * self.last + 1).astype(_U)

    def places(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.a).reshape(len(unit), self.tables, self.hashes)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """(vector, table, projection) cells, from 0."""
        at = np.floor((self.places(unit) + self.b) / self.width).astype(np.int64)
        return np.clip(at, -self.last, self.last) + self.last

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """(vector, table) bucket keys."""
        acc = np.broadcast_to(self.start, cells.shape[:-1])
        for m in range(self.hashes):
            acc = mix(acc ^ self.cell[cells[..., m]])
        return acc

    def gains(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """(vector, table, projection, cell) log ratios: chance of a neighbour there over the share of unrelated points."""
        mean = cosine * self.places(unit)[..., None]
        near = np.diff(normal_cdf((self.edges - mean) / math.sqrt(1 - cosine * cosine)), axis=-1)
        far = np.diff(normal_cdf(self.edges), axis=-1)
        return np.log(np.maximum(near, 1e-6)) - np.log(np.maximum(far, 1e-6))

    def reached(self, unit: np.ndarray, neighbours: np.ndarray, cosine: float) -> np.ndarray:
        """For every pair of rows, the largest log ratio of a table's bucket that holds the neighbour."""
        gain = np.take_along_axis(self.gains(unit, cosine), self.cells(neighbours)[..., None], -1)[..., 0]
        return gain.sum(-1).max(-1)

    def probes(self, unit: np.ndarray, to: Probing) -> tuple[np.ndarray, np.ndarray]:
        """(vector, key) of all buckets whose log ratio is at least the fitted one."""
        gain = self.gains(unit, to.cosine).reshape(len(unit) * self.tables, self.hashes, -1)
        best = gain.max(-1)
        rest = np.concatenate([np.cumsum(best[:, ::-1], axis=1)[:, ::-1], np.zeros((len(best), 1))], axis=1)
        own = np.flatnonzero(rest[:, 0] >= to.least - SLACK)
        total, key = np.zeros(len(own)), self.start[own % self.tables]
        for m in range(self.hashes):
            longer = total[:, None] + gain[own, m]
            row, cell = np.nonzero(longer + rest[own, m + 1][:, None] >= to.least - SLACK)
            own, total, key = own[row], longer[row, cell], mix(key[row] ^ self.cell[cell])
        return own // self.tables, key


def _vectors(col) -> tuple[np.ndarray, np.ndarray]:
    """(values in double precision, offsets) of an Arrow list column without nulls."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    off = col.offsets.to_numpy()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64), off - off[0]


def _by_length(col):
    """For each vector length: (rows, matrix)."""
    flat, off = _vectors(col)
    size = np.diff(off)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield rows, flat[(off[rows][:, None] + np.arange(d))]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def scores(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Cosines of the pairs (qi, xi) of the original vectors."""
    nq, nx = np.sqrt((q * q).sum(1)), np.sqrt((x * x).sum(1))
    out = np.empty(len(qi))
    for lo in range(0, len(qi), PAIRS):
        a, b = qi[lo:lo + PAIRS], xi[lo:lo + PAIRS]
        out[lo:lo + PAIRS] = np.einsum("ij,ij->i", q[a], x[b]) / (nq[a] * nx[b])
    return out


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best distinct (query, vec) of every query: by score, then smaller vec."""
    o = np.lexsort((vec, -score, query))
    q, v = query[o], vec[o]
    new = np.ones(len(o), dtype=bool)
    new[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])  # one pair has one score, so its repeats are neighbours
    o = o[new]
    q = query[o]
    start = np.searchsorted(q, q, side="left")
    return o[np.arange(len(o)) - start < k]


FOUND = "query bigint, vec_id bigint, score double"


ROWS = "bin bigint, kind int, keys array<bigint>, ids array<bigint>, v array<double>"


def _rows_of_points(points: DataFrame, bins: int, hashes: int) -> DataFrame:
    """A row for each point and table: (bin, kind 1, keys: its bucket, ids, v)."""
    def run(batches):
        made: dict[int, Hashes] = {}
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                for rows, x in _by_length(part.column("v")):
                    h = made.setdefault(x.shape[1], Hashes(x.shape[1], hashes))
                    flat = h.keys(h.cells(_unit(x))).ravel()
                    take = pa.array(np.repeat(rows, h.tables))
                    yield pa.RecordBatch.from_arrays([
                        pa.array((flat % _U(bins)).astype(np.int64)), pa.array(np.ones(len(flat), dtype=np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1), pa.int32()), pa.array(flat.view(np.int64))),
                        part.column("ids").take(take), part.column("v").take(take)], ["bin", "kind", "keys", "ids", "v"])

    return points.mapInArrow(run, ROWS)


def _rows_of_queries(queries: DataFrame, bins: int, to: Probing) -> DataFrame:
    """A row for each query and bin that it visits: (bin, kind 0, keys: the buckets there, ids: its own, v)."""
    def run(batches):
        made: dict[int, Hashes] = {}
        for b in batches:
            for lo in range(0, b.num_rows, 50):
                part = b.slice(lo, 50)
                for rows, x in _by_length(part.column("v")):
                    h = made.setdefault(x.shape[1], Hashes(x.shape[1], to.hashes))
                    row, flat = h.probes(_unit(x), to)
                    if not len(flat):
                        continue
                    bin_ = (flat % _U(bins)).astype(np.int64)
                    o = np.argsort(row * bins + bin_, kind="stable")
                    row, bin_, flat = row[o], bin_[o], flat[o]
                    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (bin_[1:] != bin_[:-1])])
                    take = pa.array(rows[row[first]])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(bin_[first]), pa.array(np.zeros(len(first), dtype=np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.r_[first, len(flat)], pa.int32()), pa.array(flat.view(np.int64))),
                        part.column("ids").take(take), part.column("v").take(take)], ["bin", "kind", "keys", "ids", "v"])

    return queries.mapInArrow(run, ROWS)


class _Asked:
    """The queries of one slot: vectors by length, buckets in key order, and the best found so far."""

    def __init__(self, rows: pa.Table, k: int):
        rows = rows.combine_chunks()
        self.k, self.id = k, rows["ids"].combine_chunks().flatten().to_numpy()
        self.by_length = {q.shape[1]: (r, q, _unit(q)) for r, q in _by_length(rows["v"])}
        self.place = np.zeros(len(rows), dtype=np.int64)
        for r, _, _ in self.by_length.values():
            self.place[r] = np.arange(len(r))
        keys = rows["keys"].combine_chunks()
        key, own = keys.flatten().to_numpy(), np.repeat(np.arange(len(rows)), np.diff(keys.offsets.to_numpy()))
        o = np.argsort(key, kind="stable")
        self.key, self.own = key[o], own[o]
        self.floor = np.full(len(rows), -np.inf)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.pending = 0

    def _settle(self) -> None:
        """Keeps the k best of every query, and raises the score that others must reach."""
        if not self.held:
            return
        own, vec, score = (np.concatenate(c) for c in zip(*self.held))
        keep = _best(own, vec, score, self.k)
        own, vec, score = own[keep], vec[keep], score[keep]
        last = np.flatnonzero(np.r_[own[1:] != own[:-1], True])
        full = np.bincount(own, minlength=len(self.id))[own[last]] == self.k
        self.floor[own[last][full]] = score[last][full]
        self.held, self.pending = [(own, vec, score)], 0

    def meet(self, part: pa.Table) -> None:
        """Compares the points of ``part`` with the queries that visit their buckets."""
        keys = part["keys"].combine_chunks().flatten().to_numpy()
        ids = part["ids"].combine_chunks()
        id_off, id_flat = ids.offsets.to_numpy() - ids.offsets[0].as_py(), ids.flatten().to_numpy()
        for xr, x in _by_length(part["v"]):
            if x.shape[1] not in self.by_length:
                continue
            _, q, unit_q = self.by_length[x.shape[1]]
            o = np.argsort(keys[xr], kind="stable")
            xr, x = xr[o], x[o]
            unit_x, key = _unit(x), keys[xr]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            lo, hi = np.searchsorted(self.key, key[first], "left"), np.searchsorted(self.key, key[first], "right")
            end = np.r_[first[1:], len(key)]
            for j in np.flatnonzero(hi > lo):  # one product a bucket
                own = self.own[lo[j]:hi[j]]
                near = unit_q[self.place[own]] @ unit_x[first[j]:end[j]].T
                qi, xi = np.nonzero(near >= self.floor[own][:, None] - SLACK)
                if not len(qi):
                    continue
                own, at = own[qi], first[j] + xi
                s = scores(q, x, self.place[own], at)
                n = id_off[xr[at] + 1] - id_off[xr[at]]
                if (n == 1).all():
                    vec = id_flat[id_off[xr[at]]]
                else:
                    vec = id_flat[np.repeat(id_off[xr[at]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                    own, s = np.repeat(own, n), np.repeat(s, n)
                self.held.append((own, vec, s))
                self.pending += len(own)
                if self.pending > PENDING:
                    self._settle()

    def found(self) -> pa.RecordBatch:
        self._settle()
        own, vec, score = self.held[0] if self.held else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        return pa.RecordBatch.from_arrays([pa.array(self.id[own]), pa.array(vec), pa.array(score)], ["query", "vec_id", "score"])


def _matched(rows: DataFrame, k: int) -> DataFrame:
    """The k best found in every slot, from rows with the queries of a slot before its points."""
    def run(batches):
        current, asked, held = None, None, []
        for b in batches:  # a slot's points come in pieces of bounded size
            for piece in (b.slice(lo, PIECE) for lo in range(0, b.num_rows, PIECE)):
                for t in groups(iter([piece]), "slot"):
                    slot = t["slot"][0].as_py()
                    if slot != current:
                        if asked is not None:
                            yield asked.found()
                        current, asked, held = slot, None, []
                    cut = int(np.searchsorted(t["kind"].to_numpy(), 1))
                    if cut:
                        held.append(t.slice(0, cut))
                    if cut == len(t) or not held:
                        continue
                    asked = asked or _Asked(pa.concat_tables(held), k)
                    asked.meet(t.slice(cut))
        if asked is not None:
            yield asked.found()

    # points by bucket, so that a bucket's points come in one piece and its queries are looked up once
    return rows.repartition("slot").sortWithinPartitions("slot", "kind", F.col("keys")[0]).mapInArrow(run, FOUND)


def _against_all(short: DataFrame, points: DataFrame, n: int, k: int) -> DataFrame:
    """Exact answers of the ``n`` queries ``short``: blocks of at most BLOCK of them, each against all points."""
    spark = short.sparkSession
    out = spark.createDataFrame([], FOUND)
    parts = -(-n // BLOCK)
    for p in range(parts):  # bounded blocks of queries, not rows of the table
        got = short.where(F.pmod(F.xxhash64("ids"), F.lit(parts)) == p).collect()
        by_dim: dict[int, list] = {}
        for r in got:
            by_dim.setdefault(len(r["v"]), []).append(r)
        asked = {d: (np.array([r["ids"][0] for r in rs], dtype=np.int64), np.array([r["v"] for r in rs], dtype=np.float64)) for d, rs in by_dim.items()}

        def run(batches, asked=asked):
            for b in batches:
                for lo in range(0, b.num_rows, 1000):
                    part = b.slice(lo, 1000)
                    ids = part.column("ids").to_pylist()
                    for rows, x in _by_length(part.column("v")):
                        if x.shape[1] not in asked:
                            continue
                        qid, q = asked[x.shape[1]]
                        for qlo in range(0, len(q), 256):
                            block = q[qlo:qlo + 256]
                            qi, xi = np.repeat(np.arange(len(block)), len(x)), np.tile(np.arange(len(x)), len(block))
                            s = scores(block, x, qi, xi)
                            m = np.array([len(ids[r]) for r in rows])
                            vec = np.concatenate([ids[r] for r in rows]).astype(np.int64)
                            first = np.cumsum(m) - m
                            nn = m[xi]
                            v = vec[np.repeat(first[xi], nn) + np.arange(nn.sum()) - np.repeat(np.cumsum(nn) - nn, nn)]
                            query, s = np.repeat(qid[qlo:qlo + 256][qi], nn), np.repeat(s, nn)
                            keep = _best(query, v, s, k)
                            yield pa.RecordBatch.from_arrays([pa.array(query[keep]), pa.array(v[keep]), pa.array(s[keep])], ["query", "vec_id", "score"])

        out = out.unionByName(points.mapInArrow(run, FOUND))
    return out


def _top(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fit(points: DataFrame, queries: DataFrame, n: int, k: int) -> Probing:
    """Probing for ``n`` points: from the exact neighbours of at most FIT_QUERIES queries among all points."""
    hashes = projections(n)
    sample = written(queries.orderBy(F.xxhash64("ids"), "ids").limit(FIT_QUERIES), "ann-sample")
    near = _top(_against_all(sample, points, FIT_QUERIES, k + 1).where("query != vec_id"), k).select("query", "vec_id")
    near = written(near, "ann-sample-near")  # at most FIT_QUERIES * k rows
    theirs = points.select(F.explode("ids").alias("vec_id"), F.col("v").alias("w")).join(F.broadcast(near), "vec_id")
    pairs = theirs.join(F.broadcast(sample.select(F.col("ids")[0].alias("query"), "v")), "query").select("v", "w").collect()
    by_dim: dict[int, list] = {}
    for v, w in pairs:
        by_dim.setdefault(len(v), []).append((v, w))
    units = {d: (_unit(np.array([v for v, _ in p])), _unit(np.array([w for _, w in p]))) for d, p in by_dim.items()}
    if not units:
        return Probing(hashes, 0.5, 0.0)
    cosines = np.concatenate([np.einsum("ij,ij->i", q, x) for q, x in units.values()])
    cosine = float(np.clip(np.median(cosines), 0.05, 0.98))
    reached = np.concatenate([Hashes(d, hashes).reached(q, x, cosine) for d, (q, x) in units.items()])
    return Probing(hashes, cosine, float(np.quantile(reached, 1 - RECALL)))


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row of ``vectors`` (vec_id, embedding) that ``is_query`` marks."""
    rows = (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
            .select("vec_id", "asks", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("v")))
    copy = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    once = rows.select("vec_id", "v").distinct().withColumn("copy", copy).where(F.col("copy") <= k + 1)
    points = written(once.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-points")
    asking = rows.where("asks").select("vec_id", "v").distinct()
    queries = written(asking.groupBy("v").agg(F.array(F.min("vec_id")).alias("ids")), "ann-queries")
    n = points.count()
    to = fit(points, queries, n, k)
    bins = max(1, -(-n * TABLES // BIN_POINTS))
    p, q = _rows_of_points(points, bins, to.hashes), _rows_of_queries(queries, bins, to)
    slices = q.groupBy("bin").agg(F.ceil(F.count("*") / SLICE).alias("slices"))
    p = p.join(slices, "bin").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)))
    q = q.join(slices, "bin").withColumn("part", F.pmod(F.xxhash64("ids"), F.col("slices")))
    both = p.unionByName(q).select(F.xxhash64("bin", "part").alias("slot"), "kind", "keys", "ids", "v")
    found = written(_top(_matched(both, k + 1), k + 1).select("query", "vec_id", "score"), "ann-found")
    enough = found.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") > k).select(F.array("query").alias("ids"))
    short = written(queries.join(enough, "ids", "left_anti"), "ann-short")
    n_short = short.count()
    if n_short:
        found = _top(found.unionByName(_against_all(short, points, n_short, k + 1)), k + 1).select("query", "vec_id", "score")
    answers = queries.select(F.col("ids")[0].alias("query"), "v").join(found, "query").select("v", "vec_id", "score")
    pairs = asking.select(F.col("vec_id").alias("query_id"), "v").join(answers, "v").where("query_id != vec_id").select("query_id", "vec_id", "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
