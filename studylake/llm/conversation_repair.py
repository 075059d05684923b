"""Conversation structure repair with Four-Russians block tables (operator 12).

A conversation's rows, by turn, are edited at least cost until their role
initials read ``(s?(ua)+)?``.  Edits: Keep 0, Rerole to user or assistant 1,
Delete 2 (the only edit of a blank or duplicate row), Insert an empty user or
assistant row 5; a truncated row that is not deleted adds 5.  Among the
cheapest edits the audit (their initials in order) that is least in ASCII wins.

The method.  An automaton has four states (start, after system, after user,
after assistant).  Costs to go from the four states, before a row, are a
vector; inserts keep its components close, so that only some dozen vectors are
left when the first component is taken off (``tables``).  A row is one of nine
symbols (must go; or system, user, assistant, other, each sound or truncated).
For every block of ``BLOCK`` symbols and every vector on its right a table
holds the vector on its left, the cost taken off, and the state that each
entry state leaves by.  A conversation is processed from its end, a block a
lookup.  The audit is traced from the front: a block is expanded backward into
its inner vectors, then the least letter on a cheapest way is taken at each
row.  A letter fixes the next state, so this choice is exact.

On Spark.  Faults, copies and gaps are DataFrame aggregates over digests, not
texts.  Rows are sorted by a range exchange on (conversation, turn, role,
digest), so a conversation of any size is cut into runs in neighbouring tasks,
and runs into chunks of ``CHUNK`` symbols.  A chunk that may be part of a
longer conversation is summed up by its table row for *all* vectors; the
summaries of a conversation (one per ``CHUNK`` rows) give each chunk its right
vector and entry state; then all chunks are traced alike.  Identical rows of a
turn are counted before they are shuffled.  Texts are shuffled once, for the
digest of the repaired rows, which is a stream over the sorted rows: memory
does not grow with a conversation but for its audit, a byte a row.

Defined results: null texts and roles count as one space.  Rows of one turn go
by role, then by the SHA-256 of the text; a null turn comes first.  A null
conv_id is a conversation.  Repeated rows are duplicates.  An empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm.common import table, written

BLOCK = 4
CHUNK = 65_536

# Costs of the edits, characters of the contract.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NOT_BLANK = r"[^\x20\x09-\x0D]"
ENDS_SOUND = r"[.!?][\x20\x09-\x0D]*\z"

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = "sua"  # initials of system, user, assistant; any other is `other`
LEGAL_PAIRS = {("s", "u"), ("u", "a"), ("a", "u")}
#: State that a kept role leads to.
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: State that the role which is due leads to (by an insert or a rerole).
DUE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
DUE_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: Costs to go behind the last row, and the inserts that end a conversation there.
END = (0, 2 * INSERT, INSERT, 0)
END_INSERTS = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

# A row's letter: initial (s, u, a, other) and condition (sound, truncated, must go).
SOUND, CUT_SHORT, MUST_GO = range(3)
LETTERS = [(initial, condition) for initial in "suao" for condition in (SOUND, CUT_SHORT, MUST_GO)]
SYMBOLS = [("", MUST_GO), *(x for x in LETTERS if x[1] != MUST_GO)]
SYMBOL_OF_LETTER = np.array([0 if c == MUST_GO else SYMBOLS.index((i, c)) for i, c in LETTERS])


def letter(initial: Column, condition: Column) -> Column:
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.chr(F.lit(65) + 3 * role + condition)


def _edits(symbol: tuple[str, int], state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that consume a row."""
    initial, condition = symbol
    out = [("D", DELETE, state)]
    if condition != MUST_GO:
        more = TRUNCATED if condition == CUT_SHORT else 0
        if (state, initial) in KEEPS:
            out.append(("K", KEEP + more, KEEPS[state, initial]))
        out.append(("R", REROLE + more, DUE[state]))
    return out


def _before(symbol: tuple[str, int], after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a row from those behind it."""
    base = [min(cost + after[to] for _, cost, to in _edits(symbol, s)) for s in range(4)]
    user = min(base[USER], INSERT + base[ASSISTANT])
    assistant = min(base[ASSISTANT], INSERT + base[USER])
    return (min(base[START], INSERT + user), min(base[SYSTEM], INSERT + user), user, assistant)


def _way(symbol: tuple[str, int], before: tuple[int, ...], after: tuple[int, ...], state: int) -> tuple[str, int]:
    """Least letters of a cheapest way through one row, and the state behind it."""
    out = ""
    while True:
        ways = [(c, to, cost + after[to]) for c, cost, to in _edits(symbol, state)]
        ways.append(("I", DUE[state], INSERT + before[DUE[state]]))
        c, to, _ = min(w for w in ways if w[2] == before[state])
        out, state = out + c, to
        if c != "I":
            return out, state


@dataclass(frozen=True)
class Tables:
    """Transitions per symbol and per block; axes: symbol or block, vector on the right, entry state."""
    vectors: list[tuple[int, ...]]
    left: np.ndarray
    cost: np.ndarray
    way: list
    block_left: np.ndarray
    block_cost: np.ndarray
    block_exit: np.ndarray


@functools.lru_cache(maxsize=2)
def tables(block: int = BLOCK) -> Tables:
    vectors, seen, moves = [END], {END: 0}, []
    for v in vectors:  # grows until no new vector is found
        for symbol in SYMBOLS:
            before = _before(symbol, v)
            norm = tuple(c - before[0] for c in before)
            if norm not in seen:
                seen[norm] = len(vectors)
                vectors.append(norm)
            moves.append((seen[norm], before[0], [_way(symbol, before, v, s) for s in range(4)]))
    n = len(SYMBOLS)
    left = np.array([m[0] for m in moves], dtype=np.int32).reshape(-1, n).T
    cost = np.array([m[1] for m in moves], dtype=np.int64).reshape(-1, n).T
    exits = np.array([[w[1] for w in m[2]] for m in moves], dtype=np.int8).reshape(-1, n, 4).transpose(1, 0, 2)
    way = [[moves[v * n + s][2] for v in range(len(vectors))] for s in range(n)]
    b_left, b_cost, b_exit = left, cost, exits
    for _ in range(block - 1):  # one symbol more, on the left
        b_cost = (b_cost[None] + cost[:, b_left]).reshape(-1, len(vectors))
        first = exits[:, b_left]
        b_exit = np.take_along_axis(np.broadcast_to(b_exit[None], first.shape), first.astype(np.int64), axis=-1).reshape(-1, len(vectors), 4)
        b_left = left[:, b_left].reshape(-1, len(vectors))
    return Tables(vectors, left, cost, way, b_left, b_cost, b_exit)


def _blocks(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """Symbols on the left that fill no block, and the blocks."""
    odd = len(symbols) % BLOCK
    power = len(SYMBOLS) ** np.arange(BLOCK - 1, -1, -1)
    return symbols[:odd].tolist(), (symbols[odd:].reshape(-1, BLOCK) @ power).tolist()


def symbols_of(letters: str) -> np.ndarray:
    return SYMBOL_OF_LETTER[np.frombuffer(letters.encode("ascii"), dtype=np.uint8) - 65]


def summary(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every vector on the right: the vector on the left, and the exit of every entry state."""
    t = tables()
    at = np.arange(len(t.vectors))
    out = np.broadcast_to(np.arange(4, dtype=np.int8), (len(at), 4))
    odd, blocks = _blocks(symbols)
    for b in reversed(blocks):
        out = np.take_along_axis(out, t.block_exit[b][at].astype(np.int64), axis=-1)
        at = t.block_left[b][at]
    for s in reversed(odd):
        step = np.array([[w[1] for w in t.way[s][v]] for v in at])
        out = np.take_along_axis(out, step, axis=-1)
        at = t.left[s][at]
    return at, out


@functools.lru_cache(maxsize=100_000)
def _expanded(block: int, right: int, state: int) -> tuple[str, int]:
    """Audit and exit state of one block, expanded backward from the vector on its right."""
    t, inner = tables(), [right]
    symbols = [block // len(SYMBOLS) ** k % len(SYMBOLS) for k in range(BLOCK)]  # last symbol first
    for s in symbols[:-1]:
        inner.append(int(t.left[s, inner[-1]]))
    out = ""
    for s, v in zip(reversed(symbols), reversed(inner), strict=True):
        piece, state = t.way[s][v][state]
        out += piece
    return out, state


def trace(symbols: np.ndarray, right: int = 0, state: int = START, last: bool = True) -> tuple[str, int, int]:
    """(audit, cost, exit state) of a chunk, given the vector on its right and its entry state."""
    t = tables()
    odd, blocks = _blocks(symbols)
    rights, cost, v = [], 0, right
    for b in reversed(blocks):
        rights.append(v)
        cost += int(t.block_cost[b, v])
        v = int(t.block_left[b, v])
    odd_rights = []
    for s in reversed(odd):
        odd_rights.append(v)
        cost += int(t.cost[s, v])
        v = int(t.left[s, v])
    cost += t.vectors[v][state]
    out = []
    for s, r in zip(odd, reversed(odd_rights), strict=True):
        piece, state = t.way[s][r][state]
        out.append(piece)
    for b, r in zip(blocks, reversed(rights), strict=True):
        piece, state = _expanded(b, r, state)
        out.append(piece)
    if last:
        out.append(END_INSERTS[state])
    return "".join(out), cost - (0 if last else t.vectors[right][state]), state


# -- rows and faults -----------------------------------------------------------

TURN = ["turn_known", "turn"]  # a null turn comes first
ROW_ORDER = ["key", *TURN, "role", "digest"]


def key_of(conv_id: Column) -> Column:
    """A text that tells conversations apart, the null one included."""
    return F.when(conv_id.isNull(), "n").otherwise(F.concat(F.lit("v"), conv_id.cast("string")))


def keyed(turns: DataFrame) -> DataFrame:
    """conv_id, key, turn, turn_known, role, text, digest, copies of every row (``copies`` is kept if present)."""
    blank = F.lit(" ")
    copies = F.col("copies").cast("bigint") if "copies" in turns.columns else F.lit(1).cast("bigint")
    rows = turns.select("conv_id", key_of(F.col("conv_id")).alias("key"), F.col("turn").cast("bigint").alias("turn"), F.col("turn").isNotNull().alias("turn_known"),
                        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), copies.alias("copies"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def marks(rows: DataFrame) -> DataFrame:
    """One row per distinct (conversation, turn, role, text), without the text: copies, blank, truncated, repeated (seen in an earlier turn)."""
    small = rows.select("key", *TURN, "role", "digest", "copies", (~F.col("text").rlike(NOT_BLANK)).alias("blank"), (~F.col("text").rlike(ENDS_SOUND)).alias("cut_short"))
    same = ["key", "role", "digest"]
    one = small.groupBy(*same, *TURN).agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("cut_short").alias("cut_short"))
    one = written(one, "conversation-rows")
    # turns are counted per text first: only texts of several turns have to look for their first one
    first = one.groupBy(*same).agg(F.min(F.struct("turn_known", "turn")).alias("first"), F.count("*").alias("n")).where("n > 1").select(*same, "first")
    return (one.join(first, same, "left")
            .withColumn("repeated", F.col("first").isNotNull() & ~F.struct("turn_known", "turn").eqNullSafe(F.col("first"))).drop("first"))


def counts(marked: DataFrame) -> DataFrame:
    """gaps, blank, duplicate, truncated of every conversation."""
    sound = ~F.col("blank") & ~F.col("repeated")
    zero = F.lit(0).cast("bigint")
    per_turn = marked.groupBy("key", *TURN).agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(zero)).alias("blank"),
        F.sum(F.when(F.col("blank"), zero).otherwise(F.col("copies") - sound.cast("bigint"))).alias("duplicate"),
        F.sum((sound & F.col("cut_short")).cast("bigint")).alias("truncated"))
    return per_turn.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), zero).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


# -- sorted letters, in chunks -----------------------------------------------------

CHUNKS = "key string, part int, seq int, whole boolean, letters string"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()

    def pieces() -> Iterator[tuple[str, str]]:
        for b in batches:
            for key, head, tail, n in zip(*(b.column(c).to_pylist() for c in ("key", "head", "tail", "copies")), strict=True):
                yield key, head
                for at in range(1, n, CHUNK):
                    yield key, tail * min(CHUNK, n - at)

    out: list[tuple] = []
    first = True
    held: list[tuple] = []  # the last chunk: it is whole only if another conversation follows in this task
    for key, run in groupby(pieces(), key=lambda x: x[0]):
        if held:
            out.extend(held)
        buffer, size, seq, done = [], 0, 0, []
        for _, s in run:
            buffer.append(s)
            size += len(s)
            if size >= CHUNK:
                out.append((key, part, seq, False, "".join(buffer)))
                buffer, size, seq = [], 0, seq + 1
        if buffer:
            done = [(key, part, seq, seq == 0 and not first, "".join(buffer))]
        held, first = done, False
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist([dict(zip(("key", "part", "seq", "whole", "letters"), r, strict=True)) for r in out], schema=_CHUNK_ARROW)
            out = []
    out.extend((k, p, s, False, x) for k, p, s, _, x in held)
    if out:
        yield pa.RecordBatch.from_pylist([dict(zip(("key", "part", "seq", "whole", "letters"), r, strict=True)) for r in out], schema=_CHUNK_ARROW)


_CHUNK_ARROW = pa.schema([("key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()), ("letters", pa.string())])


def chunks(marked: DataFrame) -> DataFrame:
    initial = F.substring("role", 1, 1)
    condition = F.when(F.col("blank") | F.col("repeated"), MUST_GO).when(F.col("cut_short"), CUT_SHORT).otherwise(SOUND)
    rows = written(marked.select(*ROW_ORDER, letter(initial, condition).alias("head"), letter(initial, F.lit(MUST_GO)).alias("tail"), "copies"), "conversation-letters")
    ordered = rows.repartitionByRange(*ROW_ORDER).sortWithinPartitions(*ROW_ORDER)
    return written(ordered.select("key", "head", "tail", "copies").mapInArrow(_chunks, CHUNKS), "conversation-chunks")


def _illegal(letters: str) -> int:
    i = (np.frombuffer(letters.encode("ascii"), dtype=np.uint8) - 65) // 3
    legal = np.zeros((4, 4), dtype=bool)
    for a, b in LEGAL_PAIRS:
        legal[ROLES.index(a), ROLES.index(b)] = True
    return int((~legal[i[:-1], i[1:]]).sum())


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = b.to_pylist()
        made = [summary(symbols_of(r["letters"])) for r in rows]
        if rows:
            yield pa.record_batch({"key": b.column("key"), "part": b.column("part"), "seq": b.column("seq"),
                                   "ends": pa.array([r["letters"][0] + r["letters"][-1] for r in rows]),
                                   "lefts": pa.array([m[0].astype(np.int32).tobytes() for m in made], pa.binary()),
                                   "exits": pa.array([m[1].astype(np.int8).tobytes() for m in made], pa.binary())})


PLACES = "key string, part int, seq int, at_right int, entry int, last boolean, seam bigint"
_PLACE_ARROW = pa.schema([("key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("at_right", pa.int32()), ("entry", pa.int32()), ("last", pa.bool_()), ("seam", pa.int64())])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Right vector and entry state of the chunks of one conversation (rows sorted by key, part, seq)."""
    for _, run in groupby((r for b in batches for r in b.to_pylist()), key=lambda r: r["key"]):
        held = list(run)
        rights, v = [], 0
        for r in reversed(held):
            rights.append(v)
            v = int(np.frombuffer(r["lefts"], dtype=np.int32)[v])
        state, out, before = START, [], ""
        for k, (r, right) in enumerate(zip(held, reversed(rights), strict=True)):
            out.append({"key": r["key"], "part": r["part"], "seq": r["seq"], "at_right": right, "entry": state, "last": k == len(held) - 1,
                        "seam": _illegal(before + r["ends"][0])})
            state = int(np.frombuffer(r["exits"], dtype=np.int8).reshape(-1, 4)[right, state])
            before = r["ends"][1]
        yield pa.RecordBatch.from_pylist(out, schema=_PLACE_ARROW)


AUDITS = "key string, part int, seq int, audit string, cost bigint, illegal bigint"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = b.to_pylist()
        made = [trace(symbols_of(r["letters"]), r["at_right"], r["entry"], r["last"]) for r in rows]
        if rows:
            yield pa.record_batch({"key": b.column("key"), "part": b.column("part"), "seq": b.column("seq"),
                                   "audit": pa.array([m[0] for m in made], pa.string()), "cost": pa.array([m[1] for m in made], pa.int64()),
                                   "illegal": pa.array([_illegal(r["letters"]) + r["seam"] for r in rows], pa.int64())})


def audits(chunked: DataFrame) -> DataFrame:
    """key, part, seq, audit, cost, illegal of every chunk; a conversation's pieces in order are its audit."""
    whole = chunked.where("whole").select("key", "part", "seq", "letters", F.lit(0).alias("at_right"), F.lit(START).alias("entry"), F.lit(True).alias("last"), F.lit(0).cast("bigint").alias("seam"))
    pieces = chunked.where("not whole")
    places = (pieces.select("key", "part", "seq", "letters").mapInArrow(_summaries, "key string, part int, seq int, ends string, lefts binary, exits binary")
              .repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(_places, PLACES))
    placed = pieces.select("key", "part", "seq", "letters").join(places, ["key", "part", "seq"])
    return written(whole.unionByName(placed.select(*whole.columns)).mapInArrow(_audits, AUDITS), "conversation-audits")


# -- repaired rows ----------------------------------------------------------------

def _edited(rows: Iterator[dict]) -> Iterator[tuple[int, dict]]:
    """(conversation number, row) of the repaired rows; rows: audit pieces of a conversation, then its texts, sorted."""
    for n, (_, run) in enumerate(groupby(rows, key=lambda r: r["key"])):
        audit, at, state = [], 0, START
        for r in run:
            if r["audit"] is not None:
                audit.append(r["audit"])
                continue
            if isinstance(audit, list):
                audit = "".join(audit)
            for _ in range(r["copies"]):
                while audit[at] == "I":
                    yield n, {**r, "role": DUE_ROLE[state], "text": "", "edit": "I"}
                    at, state = at + 1, DUE[state]
                c, at = audit[at], at + 1
                if c == "K":
                    yield n, {**r, "edit": c}
                    state = KEEPS[state, r["role"][:1]]
                elif c == "R":
                    yield n, {**r, "role": DUE_ROLE[state], "edit": c}
                    state = DUE[state]
        for _ in range(at, len(audit)):
            yield n, {**r, "role": DUE_ROLE[state], "text": "", "edit": "I"}
            state = DUE[state]


def _beside_audit(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """A conversation's audit pieces, then its rows in order, in one task."""
    none = F.lit(None)
    pieces = audit.select("key", F.lit(0).alias("kind"), "part", "seq", "audit", none.cast("boolean").alias("turn_known"), none.cast("bigint").alias("turn"),
                          none.cast("string").alias("role"), none.cast("binary").alias("digest"), none.cast("string").alias("text"), none.cast("bigint").alias("copies"))
    texts = rows.select("key", F.lit(1).alias("kind"), F.lit(0).alias("part"), F.lit(0).alias("seq"), none.cast("string").alias("audit"), *TURN, "role", "digest", "text", "copies")
    return pieces.unionByName(texts).repartition("key").sortWithinPartitions("key", "kind", "part", "seq", *TURN, "role", "digest")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    return (r for b in batches for r in b.to_pylist())


REPAIRED = "key string, position bigint, turn bigint, role string, text string, edit string"
_REPAIRED_ARROW = pa.schema([("key", pa.string()), ("position", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def repaired(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """key, position, turn, role, text, edit of the rows that stay or are added (an inserted row has the turn of the row it stands before, or of the last)."""
    def run(batches):
        held: list[dict] = []
        for _, edited in groupby(_edited(_rows(batches)), key=lambda x: x[0]):
            for position, (_, r) in enumerate(edited):
                held.append({"position": position, **{c: r[c] for c in ("key", "turn", "role", "text", "edit")}})
                if len(held) >= 500:
                    yield pa.RecordBatch.from_pylist(held, schema=_REPAIRED_ARROW)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=_REPAIRED_ARROW)

    return _beside_audit(rows, audit).mapInArrow(run, REPAIRED)


def digests(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """key and repaired_sha256 of the conversations with repaired rows."""
    def run(batches):
        out = []
        for _, edited in groupby(_edited(_rows(batches)), key=lambda x: x[0]):
            digest = hashlib.sha256()
            for k, (_, r) in enumerate(edited):
                digest.update((("\n" if k else "") + r["role"] + ":" + r["text"]).encode())
            out.append({"key": r["key"], "repaired_sha256": digest.hexdigest()})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out)

    return _beside_audit(rows, audit).mapInArrow(run, "key string, repaired_sha256 string")


def repair(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: faults of its rows in ``turns``, cost, audit and digest of the cheapest repair.

    ``turns``: conv_id, turn, role, text and, if identical rows are counted, copies.
    """
    rows = keyed(turns)
    marked = marks(rows)
    audit = audits(chunks(marked))
    whole = audit.groupBy("key").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
                                     F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    base = conversations.select("conv_id", key_of(F.col("conv_id")).alias("key")).distinct()
    found = base.join(counts(marked), "key", "left").join(whole, "key", "left").join(digests(rows, audit), "key", "left")
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


# -- the registered query ----------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the contract's damage; a row that is repeated counts two copies."""
    space = F.lit(" ")
    c = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    seed = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    c = c.withColumn("damage", F.crc32(seed) % 20).where("damage != 0")
    return c.select("conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.when(F.col("damage") == 3, 2).otherwise(1).alias("copies"))


def op12_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations)


def _sql() -> str:
    """The same by a recursion over the rows from the last to the first: per state the least (cost, audit, repaired rows)."""
    def struct(cost: str, audit: str, lines: str) -> str:
        return f"{{'c': {cost}, 's': {audit}, 'r': {lines}}}"

    def best(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def add(state: str, cost: str, edit: str, line: str | None) -> str:
        return struct(f"{cost} + {state}.c", f"'{edit}' || {state}.s", f"list_prepend({line}, {state}.r)" if line else f"{state}.r")

    def row(state: str, initials: dict[str, str], due: str, due_role: str) -> str:
        keep = [add(to, f"(CASE WHEN sound AND initial = '{i}' THEN more ELSE 1000000000 END)", "K", "role || ':' || text") for i, to in initials.items()]
        return best(add(state, "2", "D", None), *keep, add(due, "(CASE WHEN sound THEN more + 1 ELSE 1000000000 END)", "R", f"'{due_role}:' || text"))

    byte = "list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, zero: xor(x >> 1, 3988292384 * (x & 1)))"
    white = r"\x20\x09-\x0D"
    return f"""
WITH RECURSIVE seeded AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') AS key, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS seed
  FROM conversations
),
hit AS (
  SELECT key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(seed, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda crc, b: {byte}), 4294967295) % 20 AS damage
  FROM seeded
),
rows_ AS (
  SELECT key, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, LATERAL (SELECT unnest(range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy) g
),
placed AS (
  SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
    NOT regexp_matches(text, '[^{white}]') AS blank
  FROM rows_
),
faulty AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 AS duplicate,
    NOT regexp_matches(text, '[.!?][{white}]*\\z') AS cut_short,
    coalesce(lag(initial) OVER (PARTITION BY key ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed
),
r AS (SELECT *, NOT blank AND NOT duplicate AS sound, CASE WHEN cut_short THEN 5 ELSE 0 END AS more FROM faulty),
found AS (
  SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (sound AND cut_short) AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
  FROM r GROUP BY key
),
dp AS (
  SELECT key, n AS i, {struct("0", "''", "CAST([] AS VARCHAR[])")} AS p0, {struct("10", "'II'", "['user:', 'assistant:']")} AS p1,
    {struct("5", "'I'", "['assistant:']")} AS p2, {struct("0", "''", "CAST([] AS VARCHAR[])")} AS p3 FROM found
  UNION ALL
  SELECT key, i, {best("b0", add("u", "5", "I", "'user:'"))}, {best("b1", add("u", "5", "I", "'user:'"))}, u, a FROM (
    SELECT *, {best("b2", add("b3", "5", "I", "'assistant:'"))} AS u, {best("b3", add("b2", "5", "I", "'user:'"))} AS a FROM (
      SELECT dp.key, dp.i - 1 AS i, {row("p0", {"s": "p1", "u": "p2"}, "p2", "user")} AS b0, {row("p1", {"u": "p2"}, "p2", "user")} AS b1,
        {row("p2", {"a": "p3"}, "p3", "assistant")} AS b2, {row("p3", {"u": "p2"}, "p2", "user")} AS b3
      FROM dp JOIN r ON r.key = dp.key AND r.i = dp.i))
)
SELECT b.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
  coalesce(f.illegal, 0) AS illegal, CAST(coalesce(dp.p0.c, 0) AS BIGINT) AS cost, coalesce(dp.p0.s, '') AS audit,
  sha256(coalesce(array_to_string(dp.p0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM seeded) b LEFT JOIN found f ON f.key = b.key LEFT JOIN dp ON dp.key = b.key AND dp.i = 0
"""


SQL = _sql()
