"""Structure repair against a plain recursion, whole and cut into chunks; odd rows against plain Python."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from studylake.llm import conversation_repair as R

TURNS = "conv_id bigint, turn bigint, role string, text string"
sys.setrecursionlimit(20_000)  # the plain recursion goes through a conversation row by row


def letters(rows: list[tuple[str, int]]) -> str:
    return "".join(chr(65 + R.LETTERS.index(x)) for x in rows)


def cheapest(rows: tuple[tuple[str, int], ...]) -> tuple[int, str]:
    """Every edit at every row, at most three inserts in a row; least (cost, audit)."""
    @functools.lru_cache(None)
    def go(i: int, so_far: str, inserted: int) -> tuple[int, str]:
        out = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", so_far):
            out.append((0, ""))
        if inserted < 3:
            out += [add(5, "I", go(i, squeeze(so_far + r), inserted + 1)) for r in "ua" if possible(so_far + r)]
        if i < len(rows):
            initial, condition = rows[i]
            out.append(add(2, "D", go(i + 1, so_far, 0)))
            if condition != R.MUST_GO:
                more = 5 * (condition == R.CUT_SHORT)
                out += [add(more, "K", go(i + 1, squeeze(so_far + initial), 0))] if possible(so_far + initial) else []
                out += [add(1 + more, "R", go(i + 1, squeeze(so_far + r), 0)) for r in "ua" if possible(so_far + r)]
        return min(out, default=(10 ** 9, ""))

    def add(cost, c, rest):
        return cost + rest[0], c + rest[1]

    def possible(t: str) -> bool:
        return re.fullmatch("s?(ua)*u?", t) is not None

    def squeeze(t: str) -> str:  # only the last role, and whether there is one, matters
        return "s" if t == "s" else "su" if t.endswith("u") else "sua"

    return go(0, "", 0)


def test_traces_equal_the_recursion_whole_and_in_chunks():
    rng = random.Random(1)
    few = [x for n in range(4) for x in itertools.product(R.LETTERS, repeat=n)]
    many = [tuple(rng.choice(R.LETTERS) for _ in range(rng.randrange(4, 20))) for _ in range(600)]
    for rows in few + many:
        want = cheapest(rows)
        text = letters(list(rows))
        audit, cost, _ = R.trace(R.symbols_of(text))
        assert (cost, audit) == want
        if len(rows) > 4:
            a, b = sorted(rng.sample(range(1, len(rows)), 2))
            pieces = [R.symbols_of(x) for x in (text[:a], text[a:b], text[b:])]
            rights, v = [], 0
            for p in reversed(pieces):
                rights.append(v)
                v = int(R.summary(p)[0][v])
            state, got, total = R.START, "", 0
            for k, (p, right) in enumerate(zip(pieces, reversed(rights), strict=True)):
                piece, c, to = R.trace(p, right, state, last=k == 2)
                assert to == R.summary(p)[1][right, state]
                state, got, total = to, got + piece, total + c
            assert (total, got) == want


def test_block_tables_equal_single_steps():
    t = R.tables()
    assert len(t.vectors) < 64
    rng = random.Random(2)
    for _ in range(300):
        b, v, s = rng.randrange(len(t.block_left)), rng.randrange(len(t.vectors)), rng.randrange(4)
        at, cost = v, 0
        for k in range(R.BLOCK):
            symbol = b // len(R.SYMBOLS) ** k % len(R.SYMBOLS)
            cost, at = cost + t.cost[symbol, at], t.left[symbol, at]
        assert (at, cost) == (t.block_left[b, v], t.block_cost[b, v])
        assert R._expanded(b, v, s)[1] == t.block_exit[b, v, s]


def plain(rows: list[tuple]) -> dict:
    """The contract's columns of one conversation's rows (turn, role, text), by plain Python."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, conditions, faults = set(), [], []
    for _, role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if blank else "duplicate" if (role, text) in seen else "truncated" if re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        conditions.append(R.MUST_GO if fault in ("blank", "duplicate") else R.CUT_SHORT if fault else R.SOUND)
    initials = [r[:1] if r[:1] in ("s", "u", "a") else "o" for _, r, _ in rows]
    cost, audit = cheapest(tuple(zip(initials, conditions, strict=True)))
    out, so_far, i = [], "", 0
    for c in audit:
        due = "user" if so_far in ("", "s", "a") else "assistant"
        if c != "I":
            _, role, text = rows[i]
            i += 1
            if c == "D":
                continue
        role, text = {"I": (due, ""), "R": (due, text if c != "I" else ""), "K": (role, text) if c == "K" else None}[c]
        out.append(f"{role}:{text}")
        so_far = role[:1]
    turns = [t for t, _, _ in rows if t is not None]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest()}


def odd_rows(rng: random.Random) -> list[tuple]:
    texts = ["Yes.", "No", "Why?", "", None, " \t", "one.\n", "two", "a b c!", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "usher"]
    return [(rng.choice([None, *range(12)]), rng.choice([None, 0, 1, 2, 3, 4, 5, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(160)]


@pytest.mark.parametrize("chunk", [R.CHUNK, 3])
def test_repair_of_odd_rows_equals_plain_python(spark, monkeypatch, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    rows = odd_rows(random.Random(chunk)) + [(50, t, r, f"line {t}.") for t, r in enumerate(["user", "assistant"] * 150)] + [(51, None, "user", "same")] * 40
    turns = spark.createDataFrame(rows, TURNS).withColumn("key", F.lit(1)).withColumn("audit", F.lit("x")).withColumn("part", F.lit(0))
    base = turns.select("conv_id").unionByName(spark.createDataFrame([(99,)], "conv_id bigint"))
    got = {r.conv_id: r for r in R.repair(turns, base).collect()}
    own: dict = {99: []}
    for c, *r in rows:
        own.setdefault(c, []).append(tuple(r))
    assert set(got) == set(own)
    for c, mine in own.items():
        want = plain(mine)
        assert {k: got[c][k] for k in want} == want, c


def test_repaired_rows_are_alternating_turns(spark):
    rows = R.keyed(spark.createDataFrame([(1, 0, "assistant", "Hi."), (1, 1, "user", "Why"), (1, 2, "user", "How?"), (1, 3, "assistant", "So."), (2, 0, "user", " ")], TURNS))
    audit = R.audits(R.chunks(R.marks(rows)))
    out = [(r.key, r.position, r.role, r.text, r.edit) for r in R.repaired(rows, audit).orderBy("key", "position").collect()]
    assert out == [("v1", 0, "user", "How?", "K"), ("v1", 1, "assistant", "So.", "K")]


def test_an_empty_table_gives_an_empty_result(spark):
    empty = spark.createDataFrame([], TURNS)
    assert R.repair(R.damaged(empty), empty).count() == 0


def test_damage_by_the_seed(spark):
    import zlib
    given = [(c, t, "assistant", "One. Two!") for c in [None, *range(12)] for t in [None, *range(8)]]
    got = sorted((r.conv_id is not None, r.conv_id or 0, r.turn is not None, r.turn or 0, r.role, r.text, r.copies) for r in R.damaged(spark.createDataFrame(given, TURNS)).collect())
    want = []
    for c, t, role, text in given:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k:
            want.append((c is not None, c or 0, t is not None, t or 0, "user" if k == 4 else role, {1: "", 2: "One Two"}.get(k, text), 2 if k == 3 else 1))
    assert got == sorted(want)
