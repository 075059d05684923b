"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Words are runs of letters, digits and non-ASCII characters, lower-cased, so
   changed punctuation and case hide nothing.  Every item's n-grams are its
   seeds.
2. A first pass over the corpus counts, for each seed, the documents that hold
   it.  A seed is rare for its item if that count is at most RARE times the
   median over the item's seeds that occur at all, so seeds that an edit has
   destroyed everywhere do not count, and at least half of those that occur
   are rare, however many copies the corpus holds.
3. A second pass joins documents to items on the seeds.  A document that holds
   a rare seed, or common ones at SHARE of the item's places, is aligned with
   the item around them (Smith-Waterman, linear gaps); so common phrases alone
   are not, but edited copies are, whatever else the corpus holds.  A document
   leaks an item if score / best possible score reaches MIN_SCORE.

Items go to the tasks in blocks of at most BLOCK_SEEDS seeds, a size bound on
what is broadcast; a larger benchmark makes more passes, with the same result.
Documents are never shuffled.

Edge cases: null or empty texts leak nothing; an item without words matches
nothing; an item of fewer than n words matches a document that consists of
that sequence; repeated items and rows are each reported; null ids are carried
along; without documents or items no pair is found; other columns are kept by
``mark``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from studylake.llm.common import _U, NOT_ALPHANUMERIC, grams, small_batches, string_buffers, table, words

N = 3
RARE = 4
#: Common seeds lead to an alignment from this share of the item's places on, and from two.
SHARE = 0.1
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
#: Seeds of a block of items at most (16 bytes each in a task), and bits of the filter before the exact search.
BLOCK_SEEDS = 2_000_000
FILTER_BITS = 22

LEAK = "struct<item_id:bigint,score:double,from_word:bigint,to_word:bigint>"


def word_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text)."""
    h, _, _, first = words(*string_buffers(pc.utf8_lower(column)), NOT_ALPHANUMERIC)
    return h, first


class Seeds:
    """Items of a block, and which of them hold a seed at which place."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = items
        seed, item, place = [np.zeros(0, dtype=_U)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for k, (_, h) in enumerate(items):
            g, at = grams(h, np.array([0, len(h)]), N)
            seed.append(g)
            item.append(np.full(len(g), k))
            place.append(at)
        seed, item, place = map(np.concatenate, (seed, item, place))
        order = np.lexsort((place, item, seed))
        self.seed, self.item, self.place = seed[order], item[order], place[order]
        self._index()

    def _index(self) -> None:
        self.known = np.unique(self.seed)
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(self.known >> _U(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(seed, text, word) of every seed in the texts, in order of place; then all word hashes and first words."""
        h, first = word_hashes(column)
        g, at = grams(h, first, N)
        some = np.flatnonzero(self.filter[(g >> _U(64 - FILTER_BITS)).astype(np.int64)])
        if len(some) and len(self.known):
            k = np.minimum(np.searchsorted(self.known, g[some]), len(self.known) - 1)
            some = some[self.known[k] == g[some]]
        else:
            some = some[:0]
        text = np.searchsorted(first, at[some], side="right") - 1
        return g[some], text, at[some] - first[text], h, first

    def weighed(self, seed: np.ndarray, count: np.ndarray) -> Seeds:
        """This block with each item's rare seeds marked, from the documents that hold each seed; seeds in no document go."""
        n = np.zeros(len(self.seed))
        if len(seed):
            order = np.argsort(seed)
            seed, count = seed[order], count[order]
            k = np.minimum(np.searchsorted(seed, self.seed), len(seed) - 1)
            n = np.where(seed[k] == self.seed, count[k], 0)
        held = n > 0
        out = object.__new__(Seeds)
        out.items, out.seed, out.item, out.place = self.items, self.seed[held], self.item[held], self.place[held]
        n = n[held]
        out.rare = np.zeros(len(n), dtype=bool)
        order = np.argsort(out.item, kind="stable")
        edge = np.searchsorted(out.item[order], np.arange(len(out.items) + 1))
        for lo, hi in zip(edge[:-1], edge[1:], strict=True):
            if hi > lo:
                own = order[lo:hi]
                out.rare[own] = n[own] <= RARE * np.median(n[own])
        places = np.array([max(1, len(h) - N + 1) for _, h in out.items])
        out.least = np.maximum(2, np.ceil(SHARE * places))
        out._index()
        return out


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and the end of its first occurrence in ``text``.

    A row's gaps in the text are a running maximum, so each row of the matrix
    is a few array operations.
    """
    j = np.arange(1, len(text) + 1) * -GAP
    row = np.zeros(len(text) + 1, dtype=np.int64)
    best, end = 0, 0
    for w in item:
        step = np.maximum(row[:-1] + np.where(text == w, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(step, 0, out=step)
        row[1:] = np.maximum.accumulate(step + j) - j
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def leaks(seeds: Seeds, column, min_score: float) -> list[list[tuple]]:
    """For each text: (item_id, score, from_word, to_word) of the items that it leaks, the best place of each."""
    seed, text, word, h, first = seeds.hits(column)
    out: list[list[tuple]] = [[] for _ in range(len(first) - 1)]
    lo, hi = np.searchsorted(seeds.seed, seed, side="left"), np.searchsorted(seeds.seed, seed, side="right")
    many = hi - lo
    entry = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    text, start = np.repeat(text, many), np.repeat(word, many) - seeds.place[entry]
    item = seeds.item[entry]
    order = np.lexsort((seeds.place[entry], item, text))
    text, item, start, entry = text[order], item[order], start[order], entry[order]
    if len(text):
        new = np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1])]
        pair = np.cumsum(new) - 1
        place = seeds.place[entry]
        places = np.bincount(pair, new | np.r_[True, place[1:] != place[:-1]])
        near = (np.bincount(pair, seeds.rare[entry]) > 0) | (places >= seeds.least[item[new]])
        text, item, start = text[near[pair]], item[near[pair]], start[near[pair]]
        order = np.lexsort((start, item, text))
        text, item, start = text[order], item[order], start[order]
    i = 0
    while i < len(text):
        t, k = text[i], item[i]
        item_id, pattern = seeds.items[k]
        full, margin = MATCH * len(pattern), len(pattern) // 2 + 8
        body = h[first[t]:first[t + 1]]
        best = (0.0, 0, 0)
        while i < len(text) and text[i] == t and item[i] == k:
            lo_w, hi_w = start[i] - margin, start[i] + len(pattern) + margin
            i += 1
            while i < len(text) and text[i] == t and item[i] == k and start[i] - margin <= hi_w:
                hi_w = start[i] + len(pattern) + margin
                i += 1
            lo_w = max(0, lo_w)
            part = body[lo_w:hi_w]
            got, end = align(pattern, part)
            if got / full >= min_score and got / full > best[0]:
                _, back = align(pattern[::-1], part[:end][::-1])
                best = (got / full, int(lo_w + end - back), int(lo_w + end))
        if best[0]:
            out[t].append((item_id, *best))
    return out


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Items (item_id, word hashes) in blocks of about BLOCK_SEEDS seeds at most, one read after the other; an item is never cut."""
    def run(batches):
        for b in batches:
            h, first = word_hashes(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(h.view(np.int64)))], ["item_id", "words"])

    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(run, "item_id bigint, words array<bigint>").where(F.size("words") > 0)
    total = rows.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_SEEDS))
    for k in range(n):  # a driver loop over bounded blocks of the benchmark, not over rows of the corpus
        got = rows.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == k).orderBy("item_id", "words").collect() if total else []
        yield [(r["item_id"], np.array(r["words"], dtype=np.int64).view(_U)) for r in got]


def seed_counts(documents: DataFrame, seeds: Seeds) -> Seeds:
    """``seeds`` with the rare ones marked, by a pass over all documents."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 250):
                seed, text, *_ = seeds.hits(b.column("text").slice(lo, 250))
                pairs = np.unique(np.rec.fromarrays([seed, text]))
                seed, n = np.unique(pairs.f0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(n)], ["seed", "n"])

    got = documents.select("text").mapInArrow(run, "seed bigint, n bigint").groupBy("seed").agg(F.sum("n").alias("n")).collect()  # a row per seed of the block at most
    return seeds.weighed(np.array([r["seed"] for r in got], dtype=np.int64).view(_U), np.array([r["n"] for r in got], dtype=np.int64))


def mark(documents: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``documents`` with a new column leaks: array of (item_id, score, from_word, to_word), word offsets with exclusive end."""
    small_batches(documents.sparkSession)
    corpus = documents.select("text")  # seeds are counted on it, not behind the alignment of earlier blocks
    documents = documents.drop("leaks").withColumn("leaks", F.array().cast(f"array<{LEAK}>"))
    for items in item_blocks(benchmark):
        seeds = seed_counts(corpus, Seeds(items))

        def run(batches, seeds=seeds):
            for b in batches:
                found = []
                for lo in range(0, b.num_rows, 250):
                    found += leaks(seeds, b.column("text").slice(lo, 250), min_score)
                at = b.schema.get_field_index("leaks")
                names = ("item_id", "score", "from_word", "to_word")
                old = b.column(at).to_pylist()
                new = [(o or []) + [dict(zip(names, x, strict=True)) for x in f] for o, f in zip(old, found, strict=True)]
                yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

        documents = documents.mapInArrow(run, StructType(documents.schema.fields))
    return documents


def op6_seed_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return marked.where(F.size("leaks") > 0).select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*")
