"""What the n-gram Jaccard join asks of the driver: small plans, few joins that each need a broadcast of their own there."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np

import corpus_pipeline
from studylake.llm import common, ngram_jaccard
from tests.llm.helpers import documents, prose


def joins(df) -> int:
    return len(re.findall(r"\bJoin\b", df._jdf.queryExecution().optimizedPlan().toString()))


def test_tiles_do_not_repeat_the_plan_of_their_members(spark, monkeypatch):
    rng, made = random.Random(5), []
    plain = ngram_jaccard.tiles_of

    def spied(members, num, den):
        tiles = plain(members, num, den)
        made.append((joins(members), joins(tiles)))
        return tiles

    monkeypatch.setattr(ngram_jaccard, "tiles_of", spied)
    base = prose(rng, 150)
    rows = [(1, base), (2, f"{base} more"), (3, prose(rng, 150)), (4, None)]
    got = {r.doc_id: (r.component_id, r.n_links) for r in ngram_jaccard.link(documents(spark, rows)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0), 4: (4, 0)}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, documents(spark, rows), "").select("doc_id").collect()} == {1, 3, 4}
    assert len(made) == 2 and all(members == 0 and tiles <= 2 for members, tiles in made)


def test_members_of_linkable_sizes_meet_in_one_tile(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK_SHINGLES", 1 << 12)  # 4 members of a block, about
    rng = random.Random(7)
    rows = [(family, rep, rng.choice((1, 2, 40, 90, 97, 100, 105, 111, 112, 130))) for rep, family in enumerate(rng.choices((1, 2, 3), (1, 5, 20), k=130))] + [(4, 500, 7)]
    tiles = {r.rep: [(t.tile, t.side) for t in r.tiles] for r in ngram_jaccard.tiles_of(spark.createDataFrame(rows, "family bigint, rep bigint, n bigint"), 90, 100).collect()}
    assert tiles.keys() == {rep for _, rep, _ in rows}
    assert len({t for x in tiles.values() for t in x}) > 20
    for (family, a, n), (other, b, m) in itertools.combinations(rows, 2):
        shared = [(s, t) for (x, s), (y, t) in itertools.product(tiles[a], tiles[b]) if x == y and ((s, t) == (0, 0) or {s, t} == {1, 2})]
        assert len(shared) <= (family == other)
        assert shared or family != other or 10 * min(n, m) < 9 * max(n, m)


def test_modules_hold_no_large_arrays():
    """The driver imports them too, and hashes no words."""
    for module in (common, ngram_jaccard):
        assert not [k for k, v in vars(module).items() if isinstance(v, np.ndarray) and v.nbytes > 1 << 20]
