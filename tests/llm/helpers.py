"""Small odd tables: nulls everywhere, empty and long texts, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

CLASHES = "keys rep n digest leaks spans blob route quality_score ids decoded n_tokens host path low component_id family tile expected_severity grade toxic section start end".split()


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    base = prose(rng, 120)
    edited = base.split()
    edited[50] = "changed"
    return [
        (1, base), (2, base), (3, " ".join(edited)), (4, None), (5, ""), (6, "   \n\t "), (7, "one"), (8, "One"), (9, "one two"),
        (10, prose(rng, 60_000, 5000)), (11, "é漢字 " * 50), (12, "<|endoftext|> x"), (None, base), (None, None),
        (13, prose(rng, 80)), (13, prose(rng, 80)), (14, "same row"), (14, "same row"), (15, "x" * 50_000), (16, base + " " + prose(rng, 400)),
    ]


def documents(spark: SparkSession, rows=None, extra: bool = True) -> DataFrame:
    rows = odd_texts() if rows is None else rows
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    data = [(d, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "src0", None if t is None or i % 5 == 0 else len(t)) for i, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(data, schema)
    if extra:
        for c in CLASHES:
            if c not in df.columns:
                df = df.withColumn(c, df.doc_id)
    return df.repartition(3)


def save(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
