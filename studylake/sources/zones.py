"""Parquet zone sources (S-2, S-4).

The schemas are declared, partition columns included, so partition values are
not re-typed on read (D-5: subject ``007`` stays text) and no footer merge is
needed.  Filters on partition columns prune folders at planning time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas
from studylake.sinks.zones import MAX_PACKS, PACK, pack_name


def read_refine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REFINE).parquet(path)


def read_conform(spark: SparkSession, path: str, subjects: list[str] | None = None) -> DataFrame:
    """Rows of a conform zone.  With ``subjects`` those of the given codes only: their own folders and the packs that
    can hold them (see :mod:`studylake.sinks.zones`) are read, no others."""
    zone = spark.read.schema(schemas.CONFORM).parquet(path)
    if subjects is not None:
        sizes = [1 << i for i in range(MAX_PACKS.bit_length())]
        folders = [F.lit(s) for s in subjects] + [pack_name(F.lit(s), k) for s in subjects for k in sizes]
        zone = zone.where(F.col(C.SUBJECT_P).isin(*folders) & F.col(C.SUBJECT_ID).isin(*subjects))
    # an empty text is a NULL partition value, as in a folder's name
    subject = F.when(F.col(C.SUBJECT_P).startswith(PACK), F.nullif(F.col(C.SUBJECT_ID), F.lit(""))).otherwise(F.col(C.SUBJECT_P))
    return zone.withColumn(C.SUBJECT_P, subject)


def stream_refine(spark: SparkSession, path: str, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Incremental refine source (S-4): new refine files only, at most about ``max_bytes_per_trigger`` of them a micro-batch
    (a larger file comes alone), so an existing zone is not taken in at once."""
    r = spark.readStream.schema(schemas.REFINE)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return r.parquet(path)


def backlog(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """One row (files, bytes): what the load with this checkpoint has still to take from a zone.

    The zone's file list is compared with the files that the stream has logged; no file is opened.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
             .select("path", "length"))
    try:
        log = spark.read.option("recursiveFileLookup", "true").text(f"{checkpoint.rstrip('/')}/sources/0")
        seen = log.select(F.get_json_object("value", "$.path").alias("path")).filter(F.col("path").isNotNull())
        files = files.join(seen.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path")),
                           "path", "left_anti") if path.startswith(("/", "file:")) else files.join(seen, "path", "left_anti")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0).cast("bigint")).alias("bytes"))
