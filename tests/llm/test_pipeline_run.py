"""The pipeline on planted documents, odd rows and empty tables."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest

from tests.llm.helpers import CLASHES, documents, odd_texts, prose, save

RNG = random.Random(12)
ITEM = prose(RNG, 40, 3000)
SECRET = "AKIA" + "QWERTYUIOPASDFGHJKLZ"[:16]


def planted() -> list[tuple[int, str]]:
    rng = random.Random(13)
    good = [(100 + i, prose(rng, 150, 4000)) for i in range(6)]
    near = good[0][1].split()
    near[75] = "changed"
    return good + [(200, good[1][1]), (201, " ".join(near)), (202, prose(rng, 60, 4000) + " " + ITEM + " " + prose(rng, 60, 4000)),
                   (203, prose(rng, 80, 4000) + " " + SECRET + " " + prose(rng, 80, 4000))]


def folder(spark, path: str, rows, n_labels: int) -> str:
    # no row is rejected where the labels hold one class only: the other stages see all
    save(documents(spark, rows) if rows else documents(spark).limit(0), path, "documents")
    labels = [(d, 1, 0) for d, _ in (rows or []) if d is not None][:n_labels]
    save(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), path, "labels")
    save(spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id bigint, text string"), path, "benchmark")
    return path


def test_stages_take_effect_and_clean_documents_stay(spark, tmp_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontaminate", "secrets", "tokens"]
    rows = planted()
    out = corpus_pipeline.run(spark, folder(spark, f"{tmp_dir}/planted", rows, 6))
    got = {r["doc_id"]: r for r in out.collect()}
    assert sorted(got) == [*range(100, 106), 203]  # copies go, the first of each group stays; the leak goes
    text = dict(rows)
    assert all(got[d]["text"] == text[d] for d in range(100, 106))
    assert SECRET not in got[203]["text"] and got[203]["n_chars"] == len(got[203]["text"])
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in got.values())
    assert set(CLASHES) - {"n_tokens", "ids", "ids_sha256", "decoded_sha256", "decoded"} <= set(out.columns)


@pytest.mark.parametrize("rows", [odd_texts(), []], ids=["odd", "empty"])
def test_odd_and_empty_tables(spark, tmp_dir, rows):
    got = corpus_pipeline.run(spark, folder(spark, f"{tmp_dir}/{len(rows)}", rows, 0)).collect()
    kept = {r["doc_id"] for r in got}
    assert kept <= {d for d, _ in rows}
    if rows:
        assert None in kept and {1, 7, 10, 11, 12, 15} <= kept and not kept & {2, 3}
