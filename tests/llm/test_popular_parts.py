"""Passages that many texts share, in the n-gram Jaccard join: no link is lost, and texts meet few others."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from studylake.llm import ngram_jaccard
from tests.llm.helpers import documents, prose

U = np.uint64


def shared_passage(count: int) -> list[tuple[int, str]]:
    """Texts of own words with one of three passages inside; every twentieth has a near copy."""
    rng = random.Random(count)
    passages = [prose(rng, 60, 4000) for _ in range(3)]
    rows = []
    for i in range(count):
        own = [f"d{i}x{rng.randrange(4000)}" for _ in range(rng.randrange(140, 160))]
        text = [*own[:70], *passages[i % 3].split(), *own[70:]]
        rows.append((i, " ".join(text)))
        if i % 20 == 0:
            text[5] = text[90] = "changed"
            rows.append((100_000 + i, " ".join(text)))
    return rows


def test_meetings_grow_with_the_texts_not_with_their_square(spark, monkeypatch):
    made = []
    plain = ngram_jaccard.tiles_of

    def spied(members, num, den):
        tiles = plain(members, num, den)
        made.append(tiles.agg(F.sum(F.size("tiles"))).first()[0])
        return tiles

    monkeypatch.setattr(ngram_jaccard, "tiles_of", spied)
    monkeypatch.setattr(ngram_jaccard, "BLOCK_SHINGLES", 1 << 14)  # 16 members at most
    for count in (200, 800):
        rows = shared_passage(count)
        kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, documents(spark, rows), "").select("doc_id").collect()}
        assert kept == set(range(count))
    assert made[0] >= 20 and made[1] <= 8 * made[0]


def linked_pair(rng: np.random.Generator, num: int, den: int, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sets with den * |A & B| >= num * |A | B|, as far apart as the threshold allows."""
    union = rng.choice(vocabulary, rng.integers(2, 400), replace=False)
    lost = len(union) * (den - num) // den
    side = rng.random(lost) < rng.random()
    a, b = np.r_[union[lost:], union[:lost][side]], np.r_[union[lost:], union[:lost][~side]]
    return np.sort(a), np.sort(b)


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100), (60, 100)])
def test_linked_sets_share_a_part_whatever_is_popular(num, den):
    rng = np.random.default_rng(num)
    bands = ngram_jaccard.Bands(num, den)
    vocabulary = np.unique(rng.integers(0, 1 << 64, 3000, dtype=U))
    for share in (0, 0.1, 0.6, 1):
        known = vocabulary[rng.random(len(vocabulary)) < share]
        known = known, rng.integers(2, 9, len(known))
        for _ in range(300):
            a, b = linked_pair(rng, num, den, vocabulary)
            if len(a) and len(b) and not np.array_equal(a, b):
                assert np.intersect1d(ngram_jaccard.parts(a, bands, known), ngram_jaccard.parts(b, bands, known)).size


def test_popular_shingles_are_counted_by_text_and_bounded(spark, monkeypatch):
    rows = [(1, "a b c d"), (2, "a b c e"), (3, "x a b c"), (4, "a b c a b c"), (5, None), (6, ""), (7, "b c d")]
    shingle, texts = ngram_jaccard.popular(documents(spark, rows), 3)
    want = {int(s[0]): k for s, k in zip(ngram_jaccard.sets_of(pa.array(["a b c", "b c d"]), 3), (4, 2), strict=True)}
    assert dict(zip(shingle.tolist(), texts.tolist(), strict=True)) == want and sorted(want) == shingle.tolist()
    monkeypatch.setattr(ngram_jaccard, "POPULAR", 1)
    assert ngram_jaccard.popular(documents(spark, rows), 3)[1].tolist() == [4]
    assert not len(ngram_jaccard.popular(documents(spark, rows).limit(0), 3)[0])
    assert not len(ngram_jaccard.popular(documents(spark, [(1, None), (2, "")]), 3)[0])
