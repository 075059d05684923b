"""Operators that SQL cannot express, against brute force, an exact round trip or held-out labels."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from studylake.llm import ann_multiprobe, bpe_chunks, decontaminate, html_style_tree, quality_fm, token_attribution, toxicity_ordinal
from studylake.llm.byte_bpe import default_path
from tests.llm.helpers import documents, odd_texts, prose

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, n_chars bigint"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def own_tokenizer() -> Tokenizer:
    t = Tokenizer.from_file(default_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library_and_round_trips(spark):
    docs = documents(spark)
    got = bpe_chunks.decoded(bpe_chunks.encoded(docs, ids=True)).select("doc_id", "text", "n_tokens", "ids", "ids_sha256", "decoded_sha256", "decoded").collect()
    assert len(got) == len(odd_texts())
    bpe = own_tokenizer()
    for r in got:
        ids = bpe.encode(r["text"] or "", add_special_tokens=False).ids
        back = bpe.decode(ids, skip_special_tokens=False)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(",".join(map(str, ids)))
        assert r["decoded"] == back and r["decoded_sha256"] == sha(back)
    assert bpe_chunks.encoded(docs.limit(0)).count() == 0


def test_bpe_query_equals_the_library(spark):
    got = {r["doc_id"]: r for r in bpe_chunks.op9_chunk_reuse(spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    bpe = own_tokenizer()
    assert len(got) == len(texts)
    for d, text in texts:
        ids = bpe.encode(text or "", add_special_tokens=False).ids
        assert got[d]["ids_sha256"] == sha(",".join(map(str, ids)))
        assert got[d]["decoded_sha256"] == sha(bpe.decode(ids, skip_special_tokens=False))


def test_token_attribution_equals_brute_force(spark):
    rng = random.Random(5)
    texts = {i: "\n".join(prose(rng, rng.randrange(0, 9)) for _ in range(rng.randrange(1, 7))) for i in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    sections: dict[int, list] = {}
    for r in token_attribution.by_line(docs).collect():
        sections.setdefault(r["doc_id"], []).append(r)
    bpe = own_tokenizer()
    for d, text in texts.items():
        rows = sorted(sections[d], key=lambda r: r["start"])
        edges = [r["start"] for r in rows] + [rows[-1]["end"]]
        assert edges[0] == 0 and edges[-1] == len(text) and edges == sorted(edges)
        want, share, at = [0] * len(rows), [0.0] * len(rows), 0
        for i in bpe.encode(text, add_special_tokens=False).ids:
            end = at + len(bpe.decode([i]))
            parts = [max(0, min(end, r["end"]) - max(at, r["start"])) for r in rows]
            want[parts.index(max(parts))] += 1
            share = [s + p / (end - at) for s, p in zip(share, parts, strict=True)]
            at = end
        assert [r["n_tokens"] for r in rows] == want
        assert np.allclose([r["token_share"] for r in rows], share)
    odd = token_attribution.by_line(documents(spark)).groupBy().agg(F.sum("n_tokens")).first()[0]
    assert odd == sum(len(bpe.encode(t or "", add_special_tokens=False).ids) for _, t in odd_texts())


def test_quality_on_held_out_rows(spark):
    scored = quality_fm.op5_factorisation_machine(spark, SF).cache()
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert scored.where("score is null or score < 0 or score > 1 or predicted != cast(score >= 0.3 as int)").count() == 0
    held = scored.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("predicted", "quality").collect()
    assert held and np.mean([r[0] == r[1] for r in held]) >= 0.85


def test_classifiers_on_odd_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (3, None, None), (None, 1, 1), (10, 0, 0), (13, 1, 1)], "doc_id bigint, quality int, toxic int")
    for train, score, name in ((quality_fm.train, quality_fm.score, "quality_score"), (toxicity_ordinal.train, toxicity_ordinal.severity, "expected_severity")):
        for known in (labels, labels.limit(0)):
            out = score(docs, train(docs, known))
            got = [r[0] for r in out.select(name).collect()]
            assert len(got) == len(odd_texts()) and all(math.isfinite(x) and 0 <= x <= 3 for x in got)
        assert score(docs.limit(0), train(docs, labels)).count() == 0


def test_nearest_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 16))
    x[100:140] = x[100] * np.linspace(0.5, 2, 40)[:, None]  # one direction, many lengths: ties
    x[200:230] = x[200]
    rows = [(i, v.tolist(), i) for i, v in enumerate(x)]
    rows += [(500, None, 0), (550, [0.0] * 16, 0), (600, [float("nan")] + [1.0] * 15, 0), (None, x[0].tolist(), 0), (650, [None] + [1.0] * 15, 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score bigint")
    got = ann_multiprobe.search(frame, F.col("vec_id") % 50 == 0).collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T
    found: dict[int, list] = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(found) == list(range(0, 400, 50))
    hits = 0
    for q, best in found.items():
        assert len(best) == 5 and q not in [v for v, _ in best]
        assert all(abs(s - near[q, v]) < 1e-9 for v, s in best)
        assert best == sorted(best, key=lambda p: (-p[1], p[0]))
        least = np.sort(np.delete(near[q], q))[-5]
        hits += sum(s >= least - 1e-9 for _, s in best)
    assert hits >= 0.9 * 5 * len(found)
    assert ann_multiprobe.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_leaks_are_found_and_clean_documents_left_alone(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, 40, 3000)) for i in range(6)] + [(90, None), (91, "")]
    edited = items[2][1].split()
    edited[20] = "changed"
    del edited[30]
    rows = [(1, prose(rng, 300, 3000) + " " + items[0][1].upper() + " " + prose(rng, 200, 3000)), (2, " ".join(edited)),
            (3, prose(rng, 500, 3000)), (4, None), (5, ""), (None, items[1][1])]
    docs, bench = documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: {x["item_id"] for x in r["leaks"]} for r in decontaminate.mark(docs, bench).select("doc_id", "leaks").collect()}
    assert got == {1: {0}, 2: {2}, 3: set(), 4: set(), 5: set(), None: {1}}
    assert decontaminate.mark(docs, bench.limit(0)).where(F.size("leaks") > 0).count() == 0
    assert decontaminate.mark(docs.limit(0), bench).count() == 0


def test_edited_copies_are_found_whatever_else_the_corpus_holds(spark):
    rng = random.Random(12)
    items = [(1, prose(rng, 40, 3000)), (2, prose(rng, 40, 3000))]

    def edited(text: str, k: int) -> str:
        return " ".join(f"new{i}x{k}" if i % 5 == 4 else w for i, w in enumerate(text.split()))

    rows = [(1, edited(items[0][1], 0)), (2, items[1][1]), *[(10 + k, prose(rng, 50, 3000) + " " + edited(items[1][1], k)) for k in range(12)]]
    rows += [(50 + k, prose(rng, 60, 3000) + " " + " ".join(items[0][1].split()[:4])) for k in range(12)]  # a common phrase only
    got = {r["doc_id"]: {x["item_id"] for x in r["leaks"]} for r in decontaminate.mark(documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {1: {1}, 2: {2}} | {10 + k: {2} for k in range(12)} | {50 + k: set() for k in range(12)}


def test_pages_keep_the_article_only(spark):
    page = ("<html><head><title>t</title><style>p {{}}</style></head><body><nav><a href='/'>Home</a> <a href='/b'>Contact</a></nav>"
            "<article><h1>Title {0}</h1><p>First &amp; {0}\n  paragraph of the text, long enough to be read as prose.</p><p>Second {0} paragraph, which also goes on for a while.</p></article>"
            "<footer>All rights reserved</footer><script>var x = 1;</script></body></html>")
    rows = [(i, f"http://a.example/{i}", page.format(i), "x") for i in range(6)] + [(7, None, None, "x"), (8, "http://a.example/8", "", "x"), (None, "no url", "<p>loose", "x")]
    got = {r["page_id"]: r["text"] for r in html_style_tree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).select("page_id", "text").collect()}
    for i in range(6):
        assert got[i].split("\n")[-2:] == [f"First & {i} paragraph of the text, long enough to be read as prose.", f"Second {i} paragraph, which also goes on for a while."]
        assert not any(w in got[i] for w in ("Home", "Contact", "rights", "var x"))
    assert got[7] == "" and got[8] == "" and len(got) == 9


BODY = "<p>A first paragraph that is long enough to be the page's text.</p><p>And a second one, which goes on for quite a while too.</p>"


@pytest.mark.parametrize("page", [
    '<div class="content has-sidebar"><article>{0}</article></div>', '<div class="no-comments">{0}</div>', '<div class="layout ad-free">{0}</div>', '<div id="page-with-nav"><main>{0}</main></div>',
    '<article class="post comment-open">{0}</article>', '<div class="widget"><div>{0}</div></div>', '<div class="social"><article>{0}</article></div>',
    '<div>{0}</div><article><h3>Another story</h3></article>',
])
def test_names_do_not_take_the_page_text_away(page):
    text = html_style_tree.main_text('<div class="site-footer">Imprint</div><div class="ad">Buy now</div><ul id="main-menu"><li>Home</ul>' + page.format(BODY))
    want = ["A first paragraph that is long enough to be the page's text.", "And a second one, which goes on for quite a while too."]
    assert text.split("\n")[:2] == want and not any(w in text for w in ("Imprint", "Buy now", "Home"))


def test_versions_of_one_article_are_one_page(spark):
    ad = '<div class="ad">Advert {0}</div>'
    page = ("<nav>Menu <a>{0}</a></nav>{1}<article><h1>The title</h1>{1}<p>The only article of this host, held thirty times.</p></article><aside>Clock {0}</aside>")
    rows = [(i, f"http://copies.example/{i}", page.format(i, ad.format(i) * (i % 3))) for i in range(30)]
    plain = "<nav>Menu</nav>{1}<div><p>An article that is not marked, ten times with other adverts.</p></div>"
    rows += [(100 + i, f"http://plain.example/{i}", plain.format(i, ad.format(i))) for i in range(10)]
    got = {r["page_id"]: r["text"] for r in html_style_tree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: "The title\nThe only article of this host, held thirty times." for i in range(30)} | {100 + i: "An article that is not marked, ten times with other adverts." for i in range(10)}


LONG = "<p>" + "A long sentence of the article with many words. " * 4 + "</p>"


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>T</title><body><article><p>Text.</p></article>", "Text."),
    ("<head><meta charset=x><title>T</title>Hello there<p>x", "Hello there\nx"),
    ("<html><head><title>T</title><p>One<p>Two", "One\nTwo"),
    ("<p>Hello <script>var a = '<p>';</script> world</p><p>a<style>x</style>b</p>", "Hello world\nab"),
    ("<form action=/x><div><h1>Head</h1><p>First.</p><p>Second.</p></div></form>", "Head\nFirst.\nSecond."),
    ("<form><main><p>Text.</p></main></form>", "Text."),
    ("<article><p>Text.</p></article><form>search <input> terms</form>", "Text."),
    ("<article><p>Text.</p></article><article class=reply><p>I agree</p></article>", "Text."),
])
def test_main_text_of_pages_with_left_out_tags_scripts_and_forms(page, text):
    assert html_style_tree.main_text(page) == text


@pytest.mark.parametrize("name,gone", [("user-comments", True), ("comment-thread", True), ("ad-slot", True), ("sidebar-1", True), ("ad-728x90", True),
                                       ("no-comments", False), ("comment-open", False), ("has-sidebar", False), ("content", False)])
def test_noise_words_beside_another_word(name, gone):
    assert ("GONE" in html_style_tree.main_text(f'<div><h1>Title</h1>{LONG}</div><div class="{name}">GONE</div>')) != gone


def test_leaks_of_a_benchmark_in_several_blocks_equal_those_of_one(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, prose(rng, 30, 3000)) for i in range(12)] + [(99, None), (98, "")]
    texts = [(i, prose(rng, 60, 3000) + " " + items[i % 12][1] + " " + prose(rng, 40, 3000)) for i in range(30)] + [(100, None), (101, prose(rng, 50, 3000))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    show = lambda: {r.doc_id: sorted(map(tuple, r.leaks)) for r in decontaminate.mark(docs, benchmark).collect()}
    one = show()
    assert {d: [x[0] for x in found] for d, found in one.items()} == {**{i: [i % 12] for i in range(30)}, 100: [], 101: []}
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 100)
    assert len(list(decontaminate.item_blocks(benchmark))) == 4
    assert show() == one
