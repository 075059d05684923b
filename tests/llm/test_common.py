from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from studylake.llm import common


def plain_words(t: str, keep=r"[^\x20\x09-\x0D]+") -> list[str]:
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(keep, t)]


def test_words_and_grams_match_plain_python(monkeypatch):
    rng = random.Random(1)
    texts = ["", None, " a", "A b\tC\n", "x" * 40, "é É ñ", *["".join(rng.choice("abC \n\té") for _ in range(rng.randrange(200))) for _ in range(60)]]
    monkeypatch.setattr(common, "SEGMENT_BYTES", 64)  # segments are cut between words
    h, _, _, first = common.words(*common.string_buffers(pa.array(texts, pa.string())))
    own = [plain_words(t or "") for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in own]
    seen: dict[str, int] = {}
    for w, x in zip([w for t in own for w in t], h.tolist(), strict=True):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    g, at = common.grams(h, first, 3)
    want = [tuple(w[i:i + 3]) for w in own for i in (range(len(w) - 2) if len(w) >= 3 else range(min(len(w), 1)))]
    assert len(g) == len(want) == len(at)
    of: dict[tuple, int] = {}
    assert all(of.setdefault(w, x) == x for w, x in zip(want, g.tolist(), strict=True))
    assert len(set(of.values())) == len(of)


def test_slices_and_large_strings():
    a = pa.array(["zero", "one two", None, "three"])
    whole = common.words(*common.string_buffers(a))[0]
    assert (common.words(*common.string_buffers(a.slice(1)))[0] == whole[1:]).all()
    assert (common.words(*common.string_buffers(pa.chunked_array([a, a])))[0] == np.r_[whole, whole]).all()
    assert (common.words(*common.string_buffers(a.cast(pa.large_string())))[0] == whole).all()


def test_groups_stream_across_batches():
    b = [pa.RecordBatch.from_pydict({"k": k, "v": v}) for k, v in (([1, 1, 2], [0, 1, 2]), ([2], [3]), ([2, 5], [4, 5]))]
    assert [(t["k"][0].as_py(), t["v"].to_pylist()) for t in common.groups(iter(b), "k")] == [(1, [0, 1]), (2, [2, 3, 4]), (5, [5])]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, 1001 + i) for i in range(50)]
    some = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)]
    edges = chain + star + some + [(7, 7)]
    rng.shuffle(edges)
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {x: find(x) for x in root}
    empty = common.components(spark.createDataFrame([], "src bigint, dst bigint"))
    assert empty.count() == 0
