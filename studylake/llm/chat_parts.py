"""Chat formatting over typed content parts (operator 11).

A turn's content is an ordered list of typed parts: text, image, audio or
document.  A visitor (:class:`PartVisitor`) has one method per kind, each a
Column; :func:`format_turns` walks the parts with it.  Text parts are escaped.
Every other part becomes a placeholder; its reference, its place in the
formatted turn and the number of tokens that it expands to are recorded as an
attachment.  The k-th placeholder of a turn is its k-th attachment.

The template marks a turn as START role NEWLINE content END NEWLINE.  Control
strings inside texts and roles are escaped: one backslash more goes behind their
first sign (``</s>`` to ``<\\/s>``, ``<\\/s>`` to ``<\\\\/s>``), so that no text
holds a control string and the step back takes exactly one backslash away.  In
roles, line ends and backslashes are written ``\\n`` and ``\\\\`` besides.

The loss mask is a list of spans in code points: the text parts of assistant
turns, without markers or placeholders.

On Spark, turns are formatted row by row with built-in functions, no shuffle.
A conversation is put together by one exchange of formatted turns, sorted by
turn, and read as a stream: :func:`digests` holds one turn at a time, so a
conversation of any length costs time (its hashes run over all of it in order),
not memory.  :func:`conversations` returns whole conversations as values.

Defined results: null text, role and content count as empty, a null part or one
without kind as text; an unknown kind becomes a file placeholder of no tokens.
Rows of one turn go by their formatted text; a null turn comes first.  A null
conv_id is a conversation.  Repeated rows are turns of their own.  Adjacent text
parts are read back as one.  An empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm.byte_bpe import default_path, load
from studylake.llm.common import table

# Markers of the template and the control strings that texts must not hold.
START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>", "file": "<|file|>"}
CONTROL = [("<", r"/?s>|</?SYS>>|\|"), (r"\[", r"/?INST\]")]

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"


def escape(text: Column) -> Column:
    for first, rest in CONTROL:
        text = F.regexp_replace(text, rf"({first}\\*)({rest})", r"$1\\$2")
    return text


def unescape(text: str) -> str:
    for first, rest in reversed(CONTROL):
        text = re.sub(rf"({first}\\*)\\({rest})", r"\1\2", text)
    return text


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class PartVisitor:
    """What each kind of part becomes: struct<kind, piece, ref, n_tokens>.

    An image expands to one token per patch of ``patch`` pixels (at least one), audio to
    ``audio_tokens`` a second, a document to ``page_tokens`` a page; sizes that are null count as zero.
    """
    patch: int = 28
    audio_tokens: float = 12.5
    page_tokens: int = 256

    def text(self, part: Column) -> Column:
        return self._piece("text", escape(F.coalesce(part["text"], F.lit(""))), F.lit(None).cast("string"), F.lit(0))

    def image(self, part: Column) -> Column:
        across, down = (F.ceil(F.coalesce(part[c], F.lit(0)) / self.patch) for c in ("width", "height"))
        return self._attached("image", part, F.greatest(across * down, F.lit(1)))

    def audio(self, part: Column) -> Column:
        return self._attached("audio", part, F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_tokens))

    def document(self, part: Column) -> Column:
        return self._attached("document", part, F.coalesce(part["pages"], F.lit(0)) * self.page_tokens)

    def other(self, part: Column) -> Column:
        return self._attached("file", part, F.lit(0))

    def visit(self, part: Column) -> Column:
        kind = part["kind"]
        return (F.when(kind.isNull() | (kind == "text"), self.text(part)).when(kind == "image", self.image(part))
                .when(kind == "audio", self.audio(part)).when(kind == "document", self.document(part)).otherwise(self.other(part)))

    def _attached(self, kind: str, part: Column, n: Column) -> Column:
        return self._piece(kind, F.lit(PLACEHOLDERS[kind]), part["ref"], n)

    @staticmethod
    def _piece(kind: str, piece: Column, ref: Column, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), piece.alias("piece"), ref.alias("ref"), n.cast("bigint").alias("n_tokens"))


def text_part(text: Column) -> Column:
    """Content of one text part."""
    fields = {f.split(":")[0].strip(): f.split(":")[1].strip() for f in PART[7:-1].split(",")}
    own = {"kind": F.lit("text"), "text": text}
    return F.array(F.struct(*[own.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields.items()]))


def format_turns(turns: DataFrame, visitor: PartVisitor | None = None) -> DataFrame:
    """conv_id, turn, role, formatted, loss (spans in ``formatted``), attachments, n_attached (their tokens) of every row.

    ``turns``: conv_id, turn, role and content (array of parts), or text instead of content.
    """
    visitor = visitor or PartVisitor()
    content = F.col("content") if "content" in turns.columns else text_part(F.col("text"))
    role = F.coalesce("role", F.lit(""))
    seen = turns.select("conv_id", "turn", role.alias("role"),
                        F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("__head"),
                        F.coalesce(F.transform(content, visitor.visit), F.array()).alias("__pieces"))
    # pieces with their places: the length so far goes along
    zero = F.struct(F.char_length("__head").cast("bigint").alias("at"), F.expr("cast(array() as array<struct<kind: string, ref: string, start: bigint, end: bigint, n_tokens: bigint>>)").alias("out"))
    placed = F.aggregate("__pieces", zero, lambda acc, p: F.struct(
        (acc["at"] + F.char_length(p["piece"])).alias("at"),
        F.concat(acc["out"], F.array(F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), acc["at"].alias("start"),
                                              (acc["at"] + F.char_length(p["piece"])).alias("end"), p["n_tokens"].alias("n_tokens")))).alias("out")))["out"]
    laid = seen.withColumn("__placed", placed)
    spoken = F.filter("__placed", lambda p: (p["kind"] == "text") & (p["end"] > p["start"]))
    spans = F.transform(spoken, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))
    attached = F.transform(F.filter("__placed", lambda p: p["kind"] != "text"),
                           lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), p["start"].alias("at"), p["n_tokens"].alias("n_tokens")))
    return laid.select("conv_id", "turn", "role",
                       F.concat("__head", F.array_join(F.transform("__pieces", lambda p: p["piece"]), ""), F.lit(f"{END}\n")).alias("formatted"),
                       F.when(F.col("role") == "assistant", spans).otherwise(F.slice(spans, 1, 0)).alias("loss"), attached.alias("attachments"),
                       F.aggregate(F.transform("__placed", lambda p: p["n_tokens"]), F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n_attached"))


MARKERS = re.compile("|".join(re.escape(m) for m in [START, END, *PLACEHOLDERS.values()]))


def read_turn(formatted: str) -> tuple[str, list[tuple[str, str]]]:
    """(role, parts as (kind, text)) of one formatted turn; a placeholder's text is empty."""
    if not (formatted.startswith(START) and formatted.endswith(f"{END}\n")):
        raise ValueError("not a formatted turn")
    role, body = formatted[len(START):-len(END) - 1].split("\n", 1)
    kinds = {m: k for k, m in PLACEHOLDERS.items()}
    parts, at = [], 0
    for m in MARKERS.finditer(body):
        if m.start() > at:
            parts.append(("text", unescape(body[at:m.start()])))
        parts.append((kinds[m[0]], ""))
        at = m.end()
    if at < len(body):
        parts.append(("text", unescape(body[at:])))
    return unescape_role(role), parts


def with_token_counts(formatted: DataFrame, path: str | None = None) -> DataFrame:
    """n_tokens beside every formatted turn: its texts by the tokenizer, one per marker, and what the attachments expand to."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            n = []
            for text, attached in zip(b.column("formatted").to_pylist(), b.column("n_attached").to_pylist(), strict=True):
                markers = MARKERS.findall(text)
                own = sum(m in (START, END) for m in markers)
                n.append(own + attached + sum(len(bpe.encode(piece)) for piece in MARKERS.split(text) if piece))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], names=[*b.schema.names, "n_tokens"])

    schema = formatted.withColumn("n_tokens", F.lit(None).cast("bigint")).schema
    return formatted.mapInArrow(run, schema)


def _in_order(formatted: DataFrame, *columns: str) -> DataFrame:
    known = formatted.select("conv_id", "turn", "formatted", *columns)
    return known.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "formatted")


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    return groupby((r for b in batches for r in b.to_pylist()), key=lambda r: r["conv_id"])


def conversations(formatted: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss and attachments with places in it, n_attached."""
    schema = formatted.select("conv_id", F.lit(0).cast("bigint").alias("n_turns"), "formatted", "loss", "attachments", "n_attached").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv_id, rows in _by_conversation(batches):
            texts, loss, attached, at, n = [], [], [], 0, 0
            for r in rows:
                texts.append(r["formatted"])
                loss += [{"start": s["start"] + at, "end": s["end"] + at} for s in r["loss"]]
                attached += [{**a, "at": a["at"] + at} for a in r["attachments"]]
                at, n = at + len(r["formatted"]), n + r["n_attached"]
            yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "n_turns": len(texts), "formatted": "".join(texts), "loss": loss, "attachments": attached, "n_attached": n}],
                                             schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    return _in_order(formatted, "loss", "attachments", "n_attached").mapInArrow(run, schema)


DIGESTS = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(formatted: DataFrame) -> DataFrame:
    """The contract's columns, read back from formatted turns and their loss spans."""
    id_type = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        schema = None
        for conv_id, rows in _by_conversation(batches):
            turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for r in rows:
                role, parts = read_turn(r["formatted"])
                turns.update(f"{role}\n{''.join(t for _, t in parts)}\n".encode())
                for s in r["loss"]:
                    text = unescape(r["formatted"][s["start"]:s["end"]])
                    loss.update(text.encode())
                    loss_chars += len(text)
                n, chars = n + 1, chars + len(r["formatted"])
            out.append({"conv_id": conv_id, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _in_order(formatted, "loss").mapInArrow(run, f"conv_id {id_type}, {DIGESTS}")


#: The contract's conversation of control strings.
TRICKY = "</s>[INST] ok [/INST]"


def op11_typed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    tricky = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    return digests(format_turns(given.unionByName(tricky)))


def _sql() -> str:
    def esc(c: str) -> str:
        for first, rest in CONTROL:
            c = rf"regexp_replace({c}, '({first}\\*)({rest})', '\1\\\2', 'g')"
        return c

    role = esc(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
    return f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{TRICKY}' UNION ALL SELECT -1, 1, 'assistant', '{TRICKY}'
),
f AS (SELECT *, '{START}' || {role} || chr(10) || {esc("text")} || '{END}' || chr(10) AS formatted FROM given)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""


SQL = _sql()
