"""Helpers shared by the text operators: reads, written intermediates, word hashing, Arrow grouping.

Word hashing works on the UTF-8 bytes of whole Arrow batches with numpy.  A
word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.
Its 64-bit hash is a polynomial over a random byte table modulo 2**64, brought
to position 0 by the inverse power, then mixed.  Buffers are walked in
segments of about 1 MB cut at separators, so a very long text costs time, not
memory.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.session import scratch_path

SEGMENT_BYTES = 1 << 20
ARROW_ROWS = "1000"

_U = np.uint64
_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15
_IP = pow(_P, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Text rows are long: hand them to Python in batches of at most 1000 rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder under the shared folder, and read back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_until(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """As :func:`written`, and a function that removes the folder, for a reader that has written its own result since."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)

    def remove() -> None:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)

    return spark.read.schema(df.schema).parquet(path), remove


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every output bit depends on every input bit)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_BYTE[65:91] = _BYTE[97:123]
#: Bytes between words.
WHITE_SPACE = np.zeros(256, dtype=bool)
WHITE_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: All ASCII but letters and digits.
NOT_ALPHANUMERIC = np.zeros(256, dtype=bool)
NOT_ALPHANUMERIC[:128] = [not chr(c).isalnum() for c in range(128)]


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


@functools.cache
def _segment_powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers for a segment's positions: 32 MB, made where words are hashed; the driver hashes none."""
    return _powers(2 * SEGMENT_BYTES, _P), _powers(2 * SEGMENT_BYTES, _IP)


def _segment_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(b)
    pw, inv = _segment_powers()
    pw, inv = (pw[:n], inv) if n <= len(pw) else (_powers(n, _P), _powers(n, _IP))
    acc = np.zeros(n + 1, dtype=_U)
    np.cumsum(_BYTE[b] * pw, out=acc[1:])
    return mix((acc[ends] - acc[starts]) * inv[starts])


def string_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("") if col.null_count or not pa.types.is_large_string(col.type) else col
    n = len(col)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64, count=n + 1 + col.offset)[col.offset:]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, dtype=np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def words(data: np.ndarray, off: np.ndarray, separators: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte) of every word and (first word of text i, ..., number of words).

    The fourth array has len(off) entries: text i owns words first[i]:first[i + 1].
    """
    n = len(data)
    if n == 0:
        e = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=_U), e, e, np.zeros(len(off), dtype=np.int64)
    word = ~separators[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    edge[n] = True
    prev = np.empty(n, dtype=bool)
    prev[0] = False
    prev[1:] = word[:-1]
    starts = np.flatnonzero(word & (~prev | edge[:-1]))
    nxt = np.empty(n, dtype=bool)
    nxt[-1] = False
    nxt[:-1] = word[1:]
    ends = np.flatnonzero(word & (~nxt | edge[1:])) + 1
    out = np.empty(len(starts), dtype=_U)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + SEGMENT_BYTES, side="right")))
        out[i:j] = _segment_hashes(data[lo:ends[j - 1]], starts[i:j] - lo, ends[i:j] - lo)
        i = j
    return out, starts, ends, np.searchsorted(starts, off, side="left")


def grams(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word runs that stay inside one text, and the index of their first word.

    A text with 1 to n-1 words has its whole sequence as one run.
    """
    m = len(h)
    size = np.diff(first)
    own = np.repeat(np.arange(len(size)), size)
    left = first[1:][own] - np.arange(m)  # words from here to the end of the text
    acc = mix(h * _U(0x9FB21C651E98DF25) + _U(1))
    for i in range(1, n):
        nxt = np.zeros(m, dtype=_U)
        nxt[:m - i] = h[i:] if m > i else 0
        acc = np.where(left > i, (acc ^ (acc >> _U(29))) * _U(0x9FB21C651E98DF25) + nxt + _U(i + 1), acc)
    acc = mix(acc)
    at = np.flatnonzero((left >= n) | ((left == size[own]) & (left > 0)))
    return acc[at], at


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with one value of ``key`` as a table (rows must arrive sorted by ``key``)."""
    held: list[pa.RecordBatch] = []
    value = None
    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(b.schema.get_field_index(key))
        if col.null_count:
            raise ValueError(f"{key} must not be null")
        v = col.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(v[1:] != v[:-1]) + 1
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(v)], strict=True):
            if held and v[lo] != value:
                yield pa.Table.from_batches(held)
                held = []
            value = v[lo]
            held.append(b.slice(int(lo), int(hi - lo)))
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (src, dst): one row (node, component) per node.

    Component = smallest node.  Alternates the large-star and small-star steps
    (Kiveris et al., 2014) with aggregates and joins; each round is written to
    the shared folder.  A hub's rows are pre-aggregated for its minimum, and
    the join back to it can be split, as one side has one row per node.
    """
    e = written(edges.where("src != dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        # large star: every larger neighbour of a node points at the smallest neighbour (or the node itself)
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = written(large, "cc")
        # small star: a node and its smaller neighbours all point at the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        e = written(small.where("a != b").distinct(), "cc")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
