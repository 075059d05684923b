"""Chat formatting: exact round trips, places of spans and attachments, odd rows."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from studylake.llm import chat_parts as P
from studylake.llm.byte_bpe import default_path, load

TURNS = "conv_id bigint, turn bigint, role string, text string"
CONTROL_TEXTS = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>", "<\\/s>", "<\\\\|", "[\\/INST]", "<", "[", "\\", "|", "\n", "a", "<|image|>", "/s>", "é漢"]


def sha(t: str) -> str:
    return hashlib.sha256(t.encode()).hexdigest()


def hard_texts(n: int) -> list[str]:
    rng = random.Random(4)
    return ["".join(rng.choice(CONTROL_TEXTS) for _ in range(rng.randrange(12))) for _ in range(n)]


def test_escaped_texts_hold_no_control_string_and_come_back(spark):
    texts = hard_texts(400)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", "t", P.escape(P.F.col("t")).alias("e"), P.escape_role(P.F.col("t")).alias("r")).collect()
    for r in rows:
        assert P.unescape(r.e) == r.t and P.unescape_role(r.r) == r.t and "\n" not in r.r
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(CONTROL_TEXTS), max_size=8).map("".join))
def test_unescape_takes_one_backslash_of_every_control_string(text):
    import re
    escaped = text
    for first, rest in P.CONTROL:
        escaped = re.sub(rf"({first}\\*)({rest})", r"\1\\\2", escaped)
    assert P.unescape(escaped) == text


def test_digests_of_hard_turns_equal_plain_python(spark):
    rng = random.Random(9)
    texts = hard_texts(120) + [None, "", "x" * 200_000]
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 0, 1, 2, 5]), rng.choice(["user", "assistant", "system", None, "to\nol\\", "</s>"]), t) for t in texts]
    rows += rows[:5]  # repeated rows
    turns = spark.createDataFrame(rows, TURNS).withColumn("formatted", P.F.lit(1)).withColumn("loss", P.F.lit(2)).repartition(3)
    formatted = P.format_turns(turns)
    got = {r.conv_id: r for r in P.digests(formatted).collect()}
    plain = {}
    for r in formatted.collect():
        plain.setdefault(r.conv_id, []).append(r)
    originals = {(c, t, role or "", text or "") for c, t, role, text in rows}
    assert set(got) == set(plain)
    for c, own in plain.items():
        own.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.formatted.encode()))
        read = [(r, *P.read_turn(r.formatted)) for r in own]
        texts = ["".join(t for _, t in parts) for _, _, parts in read]
        assert all((c, r.turn, role, t) in originals for (r, role, _), t in zip(read, texts, strict=True))
        g = got[c]
        assert g.n_turns == len(own) and g.formatted_chars == sum(len(r.formatted) for r in own)
        assert g.turns_sha256 == sha("".join(f"{role}\n{t}\n" for (_, role, _), t in zip(read, texts, strict=True)))
        said = "".join(t for (_, role, _), t in zip(read, texts, strict=True) if role == "assistant")
        assert g.loss_sha256 == sha(said) and g.loss_chars == len(said)
    assert P.digests(P.format_turns(turns.limit(0))).count() == 0


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def mixed(spark):
    content = [
        (7, 0, "user", [part("text", "see "), part("image", ref="a.png", width=57, height=28), part("text", " and <|im_end|>"), part("audio", ref="b.wav", seconds=3.0)]),
        (7, 1, "assistant", [part("text", "yes"), part("image", ref=None), part("text", "</s> no"), part("text", " more")]),
        (7, 2, "user", [part("document", ref="c.pdf", pages=3), part("video", ref="d.mp4"), None, part(None, "bare"), part("document")]),
        (7, 3, "assistant", []), (8, 0, "assistant", None),
    ]
    return spark.createDataFrame(content, f"conv_id bigint, turn bigint, role string, content array<{P.PART}>")


def test_parts_become_ordered_placeholders_with_references_and_counts(spark):
    out = {(r.conv_id, r.turn): r for r in P.format_turns(mixed(spark)).collect()}
    user = out[7, 0]
    assert user.formatted == "<|im_start|>user\nsee <|image|> and <\\|im_end|><|audio|><|im_end|>\n"
    assert [(a.kind, a.ref, a.n_tokens) for a in user.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 38)]
    assert user.n_attached == 41 and user.loss == []
    for a in user.attachments:
        assert user.formatted[a.at:].startswith(P.PLACEHOLDERS[a.kind])
    reply = out[7, 1]
    assert [P.unescape(reply.formatted[s.start:s.end]) for s in reply.loss] == ["yes", "</s> no", " more"]
    assert P.read_turn(reply.formatted) == ("assistant", [("text", "yes"), ("image", ""), ("text", "</s> no more")])
    assert [(a.kind, a.ref, a.n_tokens) for a in out[7, 2].attachments] == [("document", "c.pdf", 768), ("file", "d.mp4", 0), ("document", None, 0)]
    assert "bare" in out[7, 2].formatted
    assert out[7, 3].formatted == out[8, 0].formatted == "<|im_start|>assistant\n<|im_end|>\n"
    assert P.format_turns(mixed(spark), P.PartVisitor(patch=14, page_tokens=10)).where("conv_id = 7 and turn = 2").first().n_attached == 30


def test_whole_conversations_keep_the_places(spark):
    rows = {r.conv_id: r for r in P.conversations(P.format_turns(mixed(spark))).collect()}
    whole = rows[7]
    assert whole.n_turns == 4 and whole.n_attached == 41 + 1 + 768
    assert [P.unescape(whole.formatted[s.start:s.end]) for s in whole.loss] == ["yes", "</s> no", " more"]
    assert [a.kind for a in whole.attachments] == ["image", "audio", "image", "document", "file", "document"]
    for a in whole.attachments:
        assert whole.formatted[a.at:].startswith(P.PLACEHOLDERS[a.kind])


def test_expanded_token_counts_equal_the_tokenizer(spark):
    bpe = load(default_path())
    for r in P.with_token_counts(P.format_turns(mixed(spark))).collect():
        pieces = [p for p in P.MARKERS.split(r.formatted) if p]
        assert r.n_tokens == 2 + r.n_attached + sum(len(bpe.encode(p)) for p in pieces)


def test_a_text_that_is_no_turn_raises():
    with pytest.raises(ValueError):
        P.read_turn("hello")
