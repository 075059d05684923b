"""Partition index of a zone (S-2): which folders a batch wrote, with row counts and time ranges.

``<zone>/_index/load_batch=<tag>/`` holds one row per folder that the batch
wrote (the leading underscore hides it from scans of the zone).  The rows come
from the batch itself, by one aggregate over its partition columns, so neither
the zone nor its files are listed for it.  A replayed batch overwrites its own
index folder, as it does its files.

A pruned read joins the index with the wanted hours and reads the folders that
match, no others: the file index of the scan holds the touched folders only,
whatever the size of the history.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake import constants as C
from studylake import schemas

INDEX = "_index"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a NULL partition value
HOURS = [C.YEAR_P, C.MONTH_P, C.DAY_P, C.HOUR_P]

ENTRY = T.StructType([*[f for f in schemas.REFINE.fields if f.name in C.REFINE_PARTITIONS],
                      T.StructField("folder", T.StringType()), T.StructField("rows", T.LongType()),
                      T.StructField("first_time", T.TimestampType()), T.StructField("last_time", T.TimestampType())])


def _folder(partitions: list[str], tag: str | None) -> Column:
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))) for c in partitions]
    return F.concat_ws("/", *([F.lit(f"{C.LOAD_BATCH}={tag}")] if tag else []), *parts)


def write_index(refine: DataFrame, zone: str, batch_tag: str | None = None) -> None:
    """Index the folders of one batch of a refine zone.  ``refine`` must be the batch that was written."""
    time = F.coalesce(F.col(C.MEASUREMENT_TIME), F.col(C.START_TIME))
    entries = refine.groupBy(*C.REFINE_PARTITIONS).agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time"))
    entries = entries.withColumn("folder", _folder(C.REFINE_PARTITIONS, batch_tag)).select(*ENTRY.fieldNames())
    (entries.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{zone.rstrip('/')}/{INDEX}/{C.LOAD_BATCH}={batch_tag or uuid.uuid4().hex}"))


def read_index(spark: SparkSession, zone: str) -> DataFrame | None:
    """All index rows, or None for a zone without an index."""
    try:
        index = spark.read.schema(ENTRY).parquet(f"{zone.rstrip('/')}/{INDEX}")
        index.schema
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return index.select(*ENTRY.fieldNames())


def folders_of(index: DataFrame, hours: DataFrame, types: list[str] | None = None) -> list[str]:
    """Folders that hold rows of the given hours (null-safe on the hour's parts) and types."""
    wanted = hours.select(*[F.col(c).alias(f"__{c}") for c in HOURS]).distinct()
    cond = F.lit(True)
    for c in HOURS:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    found = index.where(F.col(C.TYPE_P).isin(*types)) if types else index
    return [r.folder for r in found.join(wanted, cond, "left_semi").select("folder").distinct().collect()]


def read_hours(spark: SparkSession, zone: str, hours: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Refine rows of the hours that ``hours`` has rows of; only their folders are listed and read."""
    zone = zone.rstrip("/")
    index = read_index(spark, zone)
    if index is None:
        raise ValueError(f"{zone} has no partition index; write it with write_refine or write_index")
    folders = folders_of(index, hours, types)
    if not folders:
        return spark.createDataFrame([], schemas.REFINE)
    return (spark.read.schema(schemas.REFINE).option("basePath", zone).parquet(*[f"{zone}/{f}" for f in folders])
            .select(*schemas.REFINE.fieldNames()))
