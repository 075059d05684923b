"""Corpus pipeline: quality, near duplicates, benchmark leaks, secrets, tokens.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  ``run`` writes every stage's result as Parquet to the
shared folder and reads it again as the next stage's docs.  All stages but the
last return the columns of ``documents``, with the rows that they keep:

1. quality: the factorisation machine's rejects (score below 0.3) go.
2. near_duplicates: one document of each n-gram Jaccard group stays, the one
   with the smallest doc_id (five words a shingle, similarity 0.8 or more);
   of a group's rows that repeat that doc_id, the one whose text sorts first.
   Groups are of texts: a doc_id's text with no copy in its own group stays.
3. decontaminate: documents that leak a benchmark item go.
4. secrets: every span that the blob ledger's rules find is replaced by
   ``[kind]`` in the text, and n_chars follows; documents stay.
5. tokens: every text is encoded; doc_id, lang, source, n_chars, text and
   n_tokens, ids, ids_sha256, decoded_sha256.

Rows with a null doc_id cannot be grouped and pass stage 2; null texts pass
every stage that looks into texts.  Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from studylake.llm import bpe_chunks, decontaminate, ngram_jaccard, quality_fm, secret_ledger
from studylake.llm.common import table, written
from studylake.session import scratch_path

KEEP_SHINGLE, KEEP_NUM, KEEP_DEN = 5, 80, 100


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # learns from all labelled documents of the corpus, whatever part of it docs is
    model = quality_fm.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = quality_fm.score(docs, model)
    return scored.where(F.col("quality_score") >= quality_fm.KEEP_FROM).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    hashed = docs.withColumn("__row", digest)
    # other texts of a doc_id are in groups of their own, so rows go by id and text
    classes = written(ngram_jaccard.text_classes(hashed.select("doc_id", "text", F.col("__row").alias("row")), KEEP_SHINGLE, KEEP_NUM, KEEP_DEN).distinct(), "text-classes")
    gone = classes.where("low != doc_id").select("doc_id", F.col("row").alias("__row"))
    kept = hashed.join(gone, ["doc_id", "__row"], "left_anti")
    # of a group's rows that repeat an id the first text stays, found on hashes of the rows, not on the texts
    twice = kept.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    twice = written(twice, "repeated-ids")
    if twice.isEmpty():
        return kept.select(*docs.columns)
    again = (kept.join(twice, "doc_id", "left_semi")
             .join(classes.select("doc_id", F.col("row").alias("__row"), F.col("class").alias("__class")), ["doc_id", "__row"], "left"))
    first = F.row_number().over(Window.partitionBy("doc_id", "__class").orderBy(F.coalesce(F.col("text"), F.lit(""))))
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(again.withColumn("__n", first).where("__n = 1").select(*docs.columns))


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.mark(docs, table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hidden = secret_ledger.redact(docs, scratch_path(spark, "pipeline-ledger"))
    return hidden.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_chunks.encoded(docs, ids=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", remove_leaks),
    ("secrets", hide_secrets),
    ("tokens", tokens),
]

#: SQL can express neither the trained model nor the alignment nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
