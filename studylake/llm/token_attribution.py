"""Token counts by offset-mapped attribution.

Every whole document is encoded once; the byte lengths of its ids give each
token's span in the text.  Spans are joined to the document's sections (lines,
or intervals that the caller gives) by an interval search in sorted arrays,
next to the text, so tokens are never exploded into rows.  A token that
crosses a boundary is allocated by an explicit rule:

* ``most`` (the default): to the section that holds most of its bytes; ties go
  to the earlier section;
* ``start``: to the section that holds its first byte.

``token_share`` splits crossing tokens by bytes instead, so a document's
shares always sum to its tokens.  Offsets of sections are code points; inside,
they are mapped to UTF-8 bytes, as a byte-level token may hold part of a
character.

Edge cases: null text counts as empty; an empty text has one empty section
with 0 tokens; with given intervals, text outside all of them has the section
null, overlaps belong to the interval that starts first, and what lies beyond
the text is cut; null ids and repeated rows are attributed row by row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm.byte_bpe import ByteBpe, default_path, load
from studylake.llm.common import small_batches, string_buffers, table

RULES = ("most", "start")
SCHEMA = "doc_id bigint, section bigint, start bigint, end bigint, n_tokens bigint, n_crossing bigint, token_share double"


def token_ends(bpe: ByteBpe, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """End bytes in ``data`` of all tokens of all texts, each text encoded once."""
    raw = data.tobytes()
    ids = [i for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True) for i in bpe.encode(raw[a:b].decode())]
    return np.cumsum(bpe.size[ids]) if ids else np.zeros(0, dtype=np.int64)


def line_edges(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Edges of the lines of all texts; a line owns its line end."""
    return np.unique(np.r_[off, np.flatnonzero(data == 10) + 1])


def allocate(ends: np.ndarray, edges: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens by the rule, crossing tokens, shares) of each piece between consecutive ``edges``, which cover all tokens."""
    n = len(edges) - 1
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    a = np.searchsorted(edges, starts, side="right") - 1
    b = np.searchsorted(edges, ends, side="left") - 1
    inside = a == b
    tokens = np.bincount(a[inside], minlength=n)
    share = tokens.astype(float)
    crossing = np.zeros(n, dtype=np.int64)
    for s, e, i, j in zip(starts[~inside], ends[~inside], a[~inside], b[~inside], strict=True):
        held = np.minimum(edges[i + 1:j + 2], e) - np.maximum(edges[i:j + 1], s)
        share[i:j + 1] += held / (e - s)
        crossing[i:j + 1] += held > 0
        tokens[i if rule == "start" else i + int(held.argmax())] += 1
    return tokens, crossing, share


def _char_places(data: np.ndarray) -> np.ndarray:
    """Code points before every byte of ``data``, and before its end."""
    return np.r_[0, np.cumsum((data & 0xC0) != 0x80)]


def _lines(part: pa.RecordBatch, bpe: ByteBpe, rule: str) -> pa.RecordBatch:
    data, off = string_buffers(part.column("text"))
    edges = line_edges(data, off)
    # empty texts have no piece between edges: they get an empty section below
    ends = token_ends(bpe, data, off)
    tokens, crossing, share = allocate(ends, edges, rule) if len(data) else (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0),)
    char = _char_places(data)
    full = np.flatnonzero(np.diff(off))
    own = full[np.searchsorted(off[full], edges[:-1], side="right") - 1] if len(data) else np.zeros(0, dtype=np.int64)
    empty = np.flatnonzero(np.diff(off) == 0)
    row = np.r_[own, empty]
    pad = np.zeros(len(empty), dtype=np.int64)
    first = np.searchsorted(own, own, side="left")
    base = char[off[own]]
    return pa.RecordBatch.from_arrays([
        part.column("doc_id").take(pa.array(row)), pa.array(np.r_[np.arange(len(own)) - first, pad]),
        pa.array(np.r_[char[edges[:-1]] - base, pad] if len(data) else pad), pa.array(np.r_[char[edges[1:]] - base, pad] if len(data) else pad),
        pa.array(np.r_[tokens, pad]), pa.array(np.r_[crossing, pad]), pa.array(np.r_[share, pad.astype(float)])],
        ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "token_share"])


def by_line(documents: DataFrame, path: str | None = None, rule: str = "most") -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing, token_share) of every line of every text of ``documents`` (doc_id, text)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(documents.sparkSession)
    path = path or default_path()

    def run(batches):
        bpe = load(path)
        for b in batches:
            for lo in range(0, b.num_rows, 250):
                yield _lines(b.slice(lo, 250), bpe, rule)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def by_interval(documents: DataFrame, intervals: DataFrame, path: str | None = None, rule: str = "most") -> DataFrame:
    """The same for ``intervals`` (doc_id, section, start, end: code points), and a row with section null for the rest of each text.

    A document's intervals meet its text in one row, so their number in one
    document, not in all, bounds a task's memory.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark = documents.sparkSession
    small_batches(spark)
    path = path or default_path()
    given = (intervals.where("doc_id is not null and start is not null and end > start")
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.sort_array(F.collect_list(F.struct(F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), F.col("section").cast("bigint").alias("section")))).alias("wanted")))
    joined = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(given, "doc_id", "left")

    def run(batches):
        bpe = load(path)
        for b in batches:
            rows = []
            for doc, text, wanted in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "wanted")), strict=True):
                data = np.frombuffer((text or "").encode(), dtype=np.uint8)
                size, char = len(text or ""), _char_places(data)
                places, done = [], 0
                for w in wanted or []:
                    s, e = max(w["start"], done), min(w["end"], size)
                    places.append((w["section"], s, max(s, e)))
                    done = max(done, e)
                at = np.searchsorted(char, np.arange(size + 1), side="right") - 1  # first byte of each code point
                edges = np.unique(np.array([0, len(data)] + [int(at[min(x, size)]) for p in places for x in p[1:]]))
                tokens, crossing, share = allocate(token_ends(bpe, data, np.array([0, len(data)])), edges, rule) if len(edges) > 1 else ([], [], [])
                piece = {int(x): k for k, x in enumerate(edges[:-1])}
                used = set()
                for section, s, e in places:
                    k = piece.get(int(at[min(s, size)])) if e > s else None
                    used.add(k)
                    rows.append((doc, section, s, e, *((int(tokens[k]), int(crossing[k]), float(share[k])) if k is not None else (0, 0, 0.0))))
                rest = [k for k in range(len(edges) - 1) if k not in used]
                rows.append((doc, None, None, None, int(sum(tokens[k] for k in rest)), int(sum(crossing[k] for k in rest)), float(sum(share[k] for k in rest))))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 6 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols or [[]] * 7, kinds, strict=True)], ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "token_share"])

    return joined.mapInArrow(run, SCHEMA)


def op1_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_line(table(spark, sf_dir, "documents"))
