"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the UTF-8 bytes cuts every text where the content says so
(about every 2 KB), so copies and near copies are cut alike.  A task encodes
each distinct chunk once and reuses its ids.  The joins are then repaired: the
stretch from the last place in the left chunk to the first place in the right
chunk where any encoding must have a boundary (a sign before a space or line
end) is encoded again.  At both ends the new ids must meet a boundary of the
chunks' own ids, else the stretch is widened to the next such place, up to
whole chunks.  The result is the encoding of the whole text.

To bring sharers together, texts are dealt out by their smallest chunk hash:
copies, and near copies that keep that chunk, meet in one task.  A hash that
more than a thousandth of all rows share is dealt out over several tasks by a
salt (the list of such hashes has at most a thousand entries).  Only speed
depends on who meets whom.  A task's memory for chunks is bounded: the oldest
go first.

Edge cases: null text counts as empty and has no ids; a text without a cut is
one chunk; repeated rows are encoded from memory; rows with a null id are
kept; an empty table gives an empty result; other columns are kept by
``encoded``.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from studylake.llm.byte_bpe import ByteBpe, default_path, load
from studylake.llm.common import _BYTE, small_batches, string_buffers, table

#: A cut about every 2 ** CUT_BITS bytes, decided by the WINDOW bytes before it (a power of two).
CUT_BITS = 11
WINDOW = 16
#: Chunks longer than this are cut at every multiple of it, to bound what is held and encoded at once.
MAX_CHUNK = 1 << 20
#: Ids that a task remembers at most.
MEMORY_IDS = 8_000_000

_ROLL = (_BYTE >> np.uint64(32)).astype(np.uint32)
_MULT = 0x9E3779B1


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sorted chunk edges in ``data`` (texts at ``off``), with all of ``off``; every edge is at a character."""
    n = len(data)
    found = []
    for lo in range(0, n, 1 << 20):
        a = max(0, lo - WINDOW + 1)
        b = data[a:min(n, lo + (1 << 20))]
        h, width, mult = _ROLL[b], 1, _MULT
        while width < WINDOW:  # the hash of a window twice as wide, from two windows
            h[width:] = h[width:] + np.uint32(mult) * h[:-width]
            width, mult = 2 * width, mult * mult & 0xFFFFFFFF
        at = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + a + 1
        found.append(at[at > lo])
    at = np.unique(np.concatenate([*found, off])) if found else np.unique(off)
    at = at[at < n]
    text = np.searchsorted(off, at, side="right") - 1
    at = at[((at - off[text] >= WINDOW) | (at == off[text])) & ((data[at] & 0xC0) != 0x80)]
    edges = np.unique(np.r_[at, off])
    if (np.diff(edges) > MAX_CHUNK).any():
        more = np.concatenate([np.arange(a + MAX_CHUNK, b, MAX_CHUNK) for a, b in zip(edges[:-1], edges[1:], strict=True)])
        for _ in range(3):
            more = np.where((data[more] & 0xC0) == 0x80, more - 1, more)
        edges = np.unique(np.r_[edges, more])
    return edges


def anchors(data: np.ndarray) -> np.ndarray:
    """Places where every encoding has a boundary: an ASCII sign before them, a space or line end at them.

    No pre-token holds white space after another sign, and none looks back, so
    texts cut here encode piece by piece.
    """
    if len(data) < 2:
        return np.zeros(0, dtype=np.int64)
    left, right = data[:-1], data[1:]
    return np.flatnonzero((left > 0x20) & (left < 0x7F) & ((right == 0x20) | (right == 0x0A))) + 1


class ChunkEncoder:
    """Encodes texts by chunks, remembering the ids of the chunks it saw."""

    def __init__(self, bpe: ByteBpe, memory_ids: int = MEMORY_IDS):
        self.bpe, self.memory_ids = bpe, memory_ids
        self.known: OrderedDict[bytes, tuple[list[int], np.ndarray]] = OrderedDict()
        self.held = 0
        self.encoded_chunks = self.reused_chunks = self.repaired = 0

    def chunk(self, raw: bytes) -> tuple[list[int], np.ndarray]:
        """(ids, byte offset after each id) of a chunk on its own."""
        key = xxhash.xxh3_128_digest(raw)
        got = self.known.get(key)
        if got is not None:
            self.reused_chunks += 1
            return got
        self.encoded_chunks += 1
        ids = self.bpe.encode(raw.decode())
        got = ids, np.cumsum(self.bpe.size[ids]).astype(np.int32) if ids else np.zeros(0, dtype=np.int32)
        self.known[key] = got
        self.held += len(ids)
        while self.held > self.memory_ids and len(self.known) > 1:
            self.held -= len(self.known.popitem(last=False)[1][0])
        return got

    def texts(self, data: np.ndarray, off: np.ndarray, edges: np.ndarray):
        """The ids of every text in turn."""
        raw = data.tobytes()
        place = anchors(data)
        first = np.searchsorted(edges, off)
        lo = np.searchsorted(place, edges[:-1], side="right")  # an anchor needs the sign before it in the chunk too
        hi = np.searchsorted(place, edges[1:], side="left")
        for t in range(len(off) - 1):
            a, b = first[t], first[t + 1]
            if not self.bpe.joinable:
                yield self.bpe.encode(raw[off[t]:off[t + 1]].decode())
                continue
            out: list[int] = []
            done = int(off[t])  # up to here the ids are final
            for c in range(a, b):
                s, e = int(edges[c]), int(edges[c + 1])
                ids, ends = self.chunk(raw[s:e])
                begin = 0
                if done < s:  # what the last chunk left open, up to an anchor in this one where both encodings agree
                    k = lo[c]
                    while k < hi[c]:
                        p = int(place[k])
                        begin = int(np.searchsorted(ends, p - s))
                        if ends[begin] == p - s:
                            begin += 1
                            break
                        k += 1
                    if k >= hi[c]:
                        continue  # no such place here: widen into the next chunk
                    out += self.bpe.encode(raw[done:p].decode())
                    self.repaired += 1
                    done = p
                # keep this chunk's ids up to its last anchor; the rest is open, unless the text ends here
                stop, upto = len(ids), e
                if c + 1 < b:
                    k, stop, upto = hi[c] - 1, begin, done
                    while k >= lo[c] and place[k] > done:
                        x = int(np.searchsorted(ends, place[k] - s))
                        if ends[x] == place[k] - s:
                            stop, upto = x + 1, int(place[k])
                            break
                        k -= 1
                out += ids[begin:stop]
                done = upto
            if done < off[t + 1]:
                out += self.bpe.encode(raw[done:off[t + 1]].decode())
            yield out


def _routes(documents: DataFrame) -> DataFrame:
    """``documents`` with the column __route: texts with one smallest chunk hash share it, unless that is hot."""

    def keys(column) -> list[int]:
        data, off = string_buffers(column)
        edges = cuts(data, off)
        raw, first = data.tobytes(), np.searchsorted(edges, off)
        h = [xxhash.xxh3_64_intdigest(raw[a:b]) >> 1 for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        return [min(h[a:b], default=0) for a, b in zip(first[:-1], first[1:], strict=True)]

    def run_keys(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([k for lo in range(0, b.num_rows, 250) for k in keys(b.column("text").slice(lo, 250))], pa.int64())], ["key"])

    seen = documents.select("text").mapInArrow(run_keys, "key bigint").groupBy("key").agg(F.count("*").alias("n"))
    share = max(1000, documents.count() // 1000)
    hot = {r["key"]: -(-r["n"] // share) for r in seen.where(F.col("n") > share).collect()}  # a thousand rows at most

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("__route")
            key = np.array([k for lo in range(0, b.num_rows, 250) for k in keys(b.column("text").slice(lo, 250))], dtype=np.int64)
            salt = b.column(at).to_numpy().copy()
            for i, k in enumerate(key.tolist()):
                salt[i] = salt[i] % hot[k] if k in hot else 0
            yield b.set_column(at, b.schema.field(at), pa.array(key ^ (salt * 0x5851F42D4C957F2D & 0x7FFFFFFFFFFFFFFF)))

    # the salt is a hash of the row, so a task that runs again deals its rows out as before
    plain = [c for c, kind in documents.dtypes if "map<" not in kind and kind != "variant"]
    return documents.withColumn("__route", F.xxhash64(*plain)).mapInArrow(run, StructType(list(documents.schema.fields)).add("__route", LongType()))


def encoded(documents: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """``documents`` (any columns, with text) and n_tokens, ids_sha256, decoded_sha256, with ``ids`` also the ids.

    ids_sha256: of the decimal ids joined by commas.  decoded_sha256: of the
    decoded text in UTF-8.
    """
    small_batches(documents.sparkSession)
    path = path or default_path()
    source = documents.drop("__route", "n_tokens", "ids_sha256", "decoded_sha256", "ids")
    schema = StructType(list(source.schema.fields)).add("n_tokens", LongType()).add("ids_sha256", StringType()).add("decoded_sha256", StringType())
    schema = schema.add("ids", ArrayType(IntegerType())) if ids else schema

    def run(batches):
        bpe = load(path)
        coder = ChunkEncoder(bpe)
        for b in batches:
            for lo in range(0, b.num_rows, 250):
                part = b.slice(lo, 250)
                data, off = string_buffers(part.column("text"))
                n, a, d, got = [], [], [], []
                for x in coder.texts(data, off, cuts(data, off)):
                    n.append(len(x))
                    a.append(hashlib.sha256(",".join(map(bpe.digits.__getitem__, x)).encode()).hexdigest())
                    d.append(hashlib.sha256(bpe.decode(x).encode()).hexdigest())
                    if ids:
                        got.append(x)
                out = part.drop_columns(["__route"]).append_column("n_tokens", pa.array(n, pa.int64())).append_column("ids_sha256", pa.array(a, pa.string())).append_column("decoded_sha256", pa.array(d, pa.string()))
                yield out.append_column("ids", pa.array(got, pa.list_(pa.int32()))) if ids else out

    return _routes(source).repartition("__route").mapInArrow(run, schema)


def decoded(frame: DataFrame, path: str | None = None) -> DataFrame:
    """``frame`` (with ids) and a new column decoded: the text of the ids."""
    path = path or default_path()
    source = frame.drop("decoded")

    def run(batches):
        bpe = load(path)
        for b in batches:
            yield b.append_column("decoded", pa.array([bpe.decode(x or []) for x in b.column("ids").to_pylist()], pa.string()))

    return source.mapInArrow(run, StructType(list(source.schema.fields)).add("decoded", StringType()))


def op9_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
