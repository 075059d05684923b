"""Secret scan over an incremental blob ledger (native: DataFrame functions only).

Every version of every path is content-addressed (SHA-256 of its text).  The
ledger, a Parquet folder, records which (blob, rule version) pairs were
scanned, and the spans found.  A run scans only the pairs it lacks, appends
them, and joins all spans back to the paths that hold the blob.  Copies are
scanned once, a new rule version rescans only that rule, and a run that is
repeated scans nothing.

Spans are code point offsets, end exclusive.  They come from the pieces
between matches (``split``) and the matches (``regexp_extract_all``), so no
Python runs.

Edge cases: null text counts as empty; empty text has no spans; an empty table
gives an empty result; rows with a null path are kept; repeated rows get the
same spans.  A hot blob collapses in the partial aggregate, and the join back
has one row per blob on its other side, so a hot blob can be split there.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm.common import table
from studylake.session import scratch_path


class SecretRule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int       # the group whose length counts
    least: int       # fewer characters: dropped
    base: bool = False

    @property
    def tag(self) -> str:
        return f"{self.kind}@{self.version}"


# The contract's kinds, in their listed order.
BASE_RULES = (
    SecretRule("assign", 1, r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8, True),
    SecretRule("access", 1, r"(AKIA[A-Z0-9]+)", 1, 16, True),
    SecretRule("hex", 1, r"([0-9a-f]{32,})", 1, 32, True),
)
# A private key's BEGIN line, with its body: header lines, then base64 up to the END line, else up to the end of the text,
# else the long runs and a last short line of its own (prose follows).  Line ends may be escaped.  Repeats are possessive
# (no recursion over long keys).
_BEGIN, _END = "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", "-----END [A-Z ]{0,30}PRIVATE KEY-----"
_SPACE = r"(?:\\[nr]|\s)"
_HEADERS = rf"(?:{_SPACE}*+[A-Za-z][A-Za-z0-9-]*+:(?:(?!\\[nr])[^\r\n])*+)*+"
_BASE64 = rf"(?:{_SPACE}|[A-Za-z0-9+/=])*+"
_RUNS = rf"(?:{_SPACE}*+[A-Za-z0-9+/=]{{16,}}+)++(?:(?:\\[nr]|[\r\n])++[A-Za-z0-9+/=]++(?=\\[nr]|[\r\n]|\z))?+"
KEY_BLOCK = rf"({_BEGIN}(?:{_HEADERS}{_BASE64}(?:{_END}|\z)|{_HEADERS}{_RUNS}|))"
# Kinds that this method adds.
MORE_RULES = (
    SecretRule("jwt", 1, r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 28),
    SecretRule("private_key", 2, KEY_BLOCK, 1, 27),
)
RULES = BASE_RULES + MORE_RULES

#: As the ledger holds them; a reader ranks them by its own list of rules.
SPAN = "struct<start:bigint,end:bigint,kind:string,version:int>"


#: An array or text that grows by one match at a time is closed at this length and put aside, so that the work of a
#: text with many matches does not grow with their square.
RUN, RUN_CHARS = 256, 1 << 16


def rule_spans(text: Column, rule: SecretRule) -> Column:
    """Spans of a rule's leftmost non-overlapping matches, less those that are too short."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    sizes = F.zip_with(F.slice(between, F.lit(1), F.size(found)), F.arrays_zip(found.alias("m"), counted.alias("g")),
                       lambda b, x: F.struct(F.char_length(b).cast("bigint").alias("b"), F.char_length(x["m"]).cast("bigint").alias("m"), F.char_length(x["g"]).alias("g")))

    none = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["b"]
        end = start + x["m"]
        span = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version")))
        full = F.size(acc["run"]) >= RUN
        run = F.when(full, none).otherwise(acc["run"])
        return F.struct(end.alias("pos"), F.when(full, F.concat(acc["runs"], F.array(acc["run"]))).otherwise(acc["runs"]).alias("runs"),
                        F.when(x["g"] >= rule.least, F.concat(run, span)).otherwise(run).alias("run"))

    zero = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast(f"array<array<{SPAN}>>").alias("runs"), none.alias("run"))
    spans = F.aggregate(sizes, zero, step, lambda acc: F.concat(F.flatten(acc["runs"]), acc["run"]))
    return F.when(text.rlike(rule.pattern), spans).otherwise(none)


def scan_unseen(blobs: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """(blob, scanned, spans) of ``blobs`` (blob, text, todo: the tags still to be scanned)."""
    parts = [F.when(F.array_contains("todo", r.tag), rule_spans(F.col("text"), r)).otherwise(F.array().cast(f"array<{SPAN}>")) for r in rules]
    return blobs.select("blob", F.col("todo").alias("scanned"), F.concat(*parts).alias("spans"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger's rows so far, or None before the first run."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(f"blob string, scanned array<string>, spans array<{SPAN}>").parquet(ledger)


def scan_versions(versions: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES, keep_text: bool = False) -> DataFrame:
    """All columns of ``versions`` but text (unless kept), and ``spans`` sorted by start and rule, for ``versions`` with a column text.

    Columns named blob or spans are replaced.
    Appends to the ledger what it lacked; a run that fails before the append
    commits leaves the ledger as it was.
    """
    spark = versions.sparkSession
    tags = F.array(*[F.lit(r.tag) for r in rules])
    text = F.coalesce(F.col("text"), F.lit(""))
    blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    seen = read_ledger(spark, ledger)
    if seen is None:
        blobs = blobs.withColumn("todo", tags)
    else:
        known = seen.select("blob", F.explode("scanned").alias("tag")).groupBy("blob").agg(F.collect_set("tag").alias("known"))
        blobs = (blobs.join(known, "blob", "left")
                 .withColumn("todo", F.array_except(tags, F.coalesce("known", F.array().cast("array<string>"))))
                 .where(F.size("todo") > 0))
    scan_unseen(blobs, rules).write.mode("append").parquet(ledger)
    order = F.array(*[F.lit(r.tag) for r in rules])

    def tag(x: Column) -> Column:
        return F.concat_ws("@", x["kind"], x["version"].cast("string"))

    # spans of rule versions that are not asked for stay in the ledger, but do not count
    current = F.filter("spans", lambda x: F.array_contains(order, tag(x)))
    ranked = F.transform(current, lambda x: F.struct(x["start"].alias("start"), F.array_position(order, tag(x)).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    spans = (read_ledger(spark, ledger).where(F.size("spans") > 0).select("blob", F.explode(ranked).alias("span"))
             .groupBy("blob").agg(F.array_sort(F.collect_set("span")).alias("spans")))
    kept = versions.drop("blob", "spans").withColumn("blob", F.sha2(text, 256))
    kept = kept if keep_text else kept.drop("text")
    return (kept.join(spans, "blob", "left")
            .withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>"))))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(documents: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """``documents`` with every span of ``text`` replaced by ``[kind]``; overlapping spans become one, named by the first."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def step(acc: Column, x: Column) -> Column:
        upto = F.when(x["start"] > acc["pos"], F.substring(text, acc["pos"].cast("int") + 1, (x["start"] - acc["pos"]).cast("int"))).otherwise("")
        full = F.char_length(acc["run"]) >= RUN_CHARS
        run = F.when(full, F.lit("")).otherwise(acc["run"])
        more = F.when(x["start"] >= acc["pos"], F.concat(run, upto, F.lit("["), x["kind"], F.lit("]"))).otherwise(run)
        return F.struct(F.greatest(acc["pos"], x["end"]).alias("pos"), F.when(full, F.concat(acc["runs"], F.array(acc["run"]))).otherwise(acc["runs"]).alias("runs"), more.alias("run"))

    zero = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast("array<string>").alias("runs"), F.lit("").alias("run"))
    hidden = F.aggregate("spans", zero, step, lambda acc: F.concat(F.array_join(acc["runs"], ""), acc["run"], F.substring(text, acc["pos"].cast("int") + 1, 2147483647)))
    found = scan_versions(documents, ledger, rules, keep_text=True)
    return found.withColumn("text", F.when(F.size("spans") > 0, hidden).otherwise(F.col("text"))).select(*documents.columns)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from rows with doc_id and spans."""
    base = F.filter("spans", lambda s: s["rank"] <= len(BASE_RULES))

    def n(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op10_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(scan_versions(docs, scratch_path(spark, "secret-ledger")))


#: DuckDB's patterns have neither possessive repeats nor look-ahead: its SQL keeps the rule of version 1, the BEGIN line only.
SQL_RULES = tuple(r._replace(pattern=rf"({_BEGIN})") if r.kind == "private_key" else r for r in RULES)


def _sql_kind(rule: SecretRule, rank: int) -> str:
    pat = rule.pattern.replace("'", "''")
    return f"""select doc_id, {rank} as rank, '{rule.kind}' as kind, {str(rule.base).lower()} as base,
      unnest(list_transform(range(len(m)), lambda i: {{'s': list_sum(list_transform(b[1:i+1], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0), 'l': length(m[i+1]), 'g': length(g[i+1])}})) as x
      from (select doc_id, regexp_extract_all(text, '{pat}') as m, regexp_extract_all(text, '{pat}', {rule.group}) as g, string_split_regex(text, '{pat}') as b from d) where len(m) > 0"""


SQL = ("with d as (select row_number() over () as row_id, doc_id, coalesce(text, '') as text from documents),\n"
       "s as (" + "\nunion all\n".join(f"select *, {r.least} as least from ({_sql_kind(r, k)})" for k, r in enumerate(SQL_RULES)) + """),
k as (select doc_id, rank, kind, base, kind || ':' || cast(x.s as bigint) || ':' || cast(x.s + x.l as bigint) as span, x.s as start from s where x.g >= least),
f as (select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
  string_agg(span, ',' order by start, rank) filter (base) as base_spans, string_agg(span, ',' order by start, rank) as spans from k group by 1)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans from d left join f on d.doc_id = f.doc_id
""")
