"""The factorisation machine against the pair sum, and token attribution to given intervals against a plain loop."""

from __future__ import annotations

import numpy as np
import pytest
from tokenizers import Tokenizer

from studylake.llm import quality_fm, token_attribution
from studylake.llm.byte_bpe import default_path
from tests.llm.helpers import CLASHES, documents, odd_texts


def test_logits_equal_the_sum_over_pairs():
    rng = np.random.default_rng(6)
    model = {"w0": rng.normal(size=1), "w": rng.normal(size=30), "v": rng.normal(size=(30, 4))}
    size = np.array([1, 7, 12, 3])
    first = np.r_[0, np.cumsum(size)]
    feature, value = rng.integers(0, 30, first[-1]), rng.normal(size=first[-1])
    want = []
    for lo, hi in zip(first[:-1], first[1:]):
        f, x = feature[lo:hi], value[lo:hi]
        pairs = sum(model["v"][f[i]] @ model["v"][f[j]] * x[i] * x[j] for i in range(len(f)) for j in range(i + 1, len(f)))
        want.append(model["w0"][0] + model["w"][f] @ x + pairs)
    assert np.allclose(quality_fm.logits(model, feature, value, first), want)


def plain_intervals(text: str, intervals: list[tuple[int, int, int]], rule: str) -> list[tuple]:
    """(section, start, end, tokens, shares) per interval and for the rest; every token goes by its bytes."""
    bpe = Tokenizer.from_file(default_path())
    bpe.no_truncation()
    bpe.no_padding()
    data, at = text.encode(), [len(text[:i].encode()) for i in range(len(text) + 1)]
    owner, out, done = [None] * len(data), [], 0
    for k, (s, e, section) in enumerate(sorted(intervals)):
        s, e = max(s, done), min(e, len(text))
        e, done = max(s, e), max(done, e)
        out.append([section, s, e, 0, 0.0])
        for b in range(at[min(s, len(text))], at[min(e, len(text))]):
            owner[b] = k
    out.append([None, None, None, 0, 0.0])
    place = 0
    level = {c: b for b, c in byte_letters().items()}
    for piece in bpe.encode(text, add_special_tokens=False).tokens:
        n = len(piece) if all(c in level for c in piece) else len(piece.encode())
        held = owner[place:place + n]
        # runs of one owner, so that two gaps around an interval are two pieces
        runs = [[held[0], 0]]
        for o in held:
            if o != runs[-1][0]:
                runs.append([o, 0])
            runs[-1][1] += 1
        for o, c in runs:
            out[-1 if o is None else o][4] += c / n
        best = runs[0] if rule == "start" else max(runs, key=lambda r: r[1])
        out[-1 if best[0] is None else best[0]][3] += 1
        place += n
    assert place == len(data)
    return [tuple(r) for r in out]


def byte_letters() -> dict[int, str]:
    """The printable letter that a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}


@pytest.mark.parametrize("rule", token_attribution.RULES)
def test_given_intervals_equal_a_plain_loop(spark, rule):
    texts = [(1, "alpha beta, gamma-delta epsilon 12345 zeta"), (2, "é漢字 naïve mixed ünïcode 漢字"), (3, ""), (4, None), (5, "no interval here")]
    given = [(1, 0, 0, 8), (1, 1, 8, 20), (1, 2, 15, 25), (1, 3, 30, 999), (2, 0, 1, 3), (2, 1, 3, 9), (3, 0, 0, 5),
             (4, 0, 0, 5), (9, 0, 0, 5), (1, 7, None, 4), (1, 8, 6, 6), (None, 9, 0, 4)]
    docs = spark.createDataFrame(texts + [texts[0], (None, "lost id")], "doc_id bigint, text string")
    intervals = spark.createDataFrame(given, "doc_id bigint, section bigint, start bigint, end bigint")
    for c in CLASHES[:6]:
        docs = docs.withColumn(c, docs.doc_id)
    rows = token_attribution.by_interval(docs, intervals, rule=rule).collect()
    got = sorted(((r["doc_id"], r["section"], r["start"], r["end"], r["n_tokens"], round(r["token_share"], 9)) for r in rows), key=str)
    want = []
    for d, text in texts + [texts[0], (None, "lost id")]:
        own = [(s, e, k) for i, k, s, e in given if d is not None and i == d and s is not None and e > s]
        want += [(d, *r[:4], round(r[4], 9)) for r in plain_intervals(text or "", own, rule)]
    assert got == sorted(want, key=str)
    assert token_attribution.by_interval(docs.limit(0), intervals, rule=rule).count() == 0
    assert token_attribution.by_interval(docs, intervals.limit(0), rule=rule).count() == len(texts) + 2


def test_lines_by_rule_start_and_empty_tables(spark):
    docs = documents(spark)
    start = token_attribution.by_line(docs, rule="start").groupBy().sum("n_tokens", "token_share").first()
    most = token_attribution.by_line(docs).groupBy().sum("n_tokens").first()
    assert start[0] == most[0] == round(start[1])
    assert token_attribution.by_line(docs.limit(0)).count() == 0
    assert token_attribution.by_line(docs).where("n_crossing < 0 or n_tokens < 0 or token_share < n_tokens - n_crossing").count() == 0
    assert token_attribution.by_line(docs).select("doc_id").where("doc_id is null").count() >= sum(d is None for d, _ in odd_texts())
    with pytest.raises(ValueError):
        token_attribution.by_line(docs, rule="end")
