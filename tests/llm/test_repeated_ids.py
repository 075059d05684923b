"""Rows that repeat a doc_id with other texts, in the n-gram Jaccard join and the pipeline's near duplicates."""

from __future__ import annotations

import random

import corpus_pipeline
from studylake.llm import ngram_jaccard
from tests.llm.helpers import documents, prose


def changed(text: str, at: int) -> str:
    own = text.split()
    own[at] = "changed"
    return " ".join(own)


def repeated() -> tuple[list[tuple[int, str]], dict[str, str]]:
    rng = random.Random(5)
    t = {k: prose(rng, n, 4000) for k, n in (("A", 120), ("B", 400), ("C", 90), ("D", 300))}
    # 5 holds a short text (also of 3) and a long one (also of 9, nearly); 9 is linked to 3 through 5 only
    rows = [(3, t["A"]), (5, t["A"]), (5, t["B"]), (9, changed(t["B"], 3)), (20, t["C"]), (20, t["C"]), (21, changed(t["C"], 89)), (30, t["D"])]
    return rows, t


def test_texts_of_one_id_share_a_component(spark):
    rows, _ = repeated()
    got = sorted((r.doc_id, r.component_id, r.n_links) for r in ngram_jaccard.link(documents(spark, rows), 3, 90, 100).collect())
    assert got == [(3, 3, 1), (5, 3, 1), (5, 3, 1), (9, 3, 1), (20, 20, 2), (20, 20, 2), (21, 20, 2), (30, 30, 0)]


def test_near_duplicates_keep_a_text_of_each_group(spark):
    rows, t = repeated()
    rows += [(40, ""), (40, None), (50, changed(t["D"], 9)), (50, changed(t["D"], 8)), (60, t["A"] + " more"), (60, prose(random.Random(8), 100, 4000))]
    docs = documents(spark, rows)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((r.doc_id, r.text or "") for r in kept.collect())
    assert got == sorted([(3, t["A"]), (5, t["B"]), (20, t["C"]), (30, t["D"]), (40, ""), (60, prose(random.Random(8), 100, 4000))])


def test_equal_parts_meet_without_a_window(spark, monkeypatch):
    plans = []
    plain = ngram_jaccard.components
    monkeypatch.setattr(ngram_jaccard, "components", lambda edges: plans.append(edges._jdf.queryExecution().executedPlan().toString()) or plain(edges))
    rng = random.Random(6)
    base = prose(rng, 200, 4000)
    rows = [(i, changed(base, i)) for i in range(20)]
    assert {r.component_id for r in ngram_jaccard.link(documents(spark, rows), 3, 90, 100).collect()} == {0}
    assert plans and not any("Window" in p for p in plans)
