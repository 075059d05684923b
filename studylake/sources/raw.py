"""Raw zone sources: newline JSON in year/month/day/hour folders (S-1, S-3, S-13).

Every line is parsed with the declared schema, without an inference pass.  Bad
lines are kept in ``_corrupt_record``.  Fields that the schema does not know
(P-11: drift) are kept as text in the map column ``rest``, which goes along
through both zones; :mod:`studylake.sources.promoted` makes columns of them
later.  ``source_file`` names the file of a line, for the quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake import constants as C
from studylake import schemas

DECLARED = T.StructType([f for f in schemas.RAW.fields if f.name != C.REST])


def parsed(lines: DataFrame) -> DataFrame:
    """``value`` lines -> RAW columns, ``source_file`` and the partition columns of the path."""
    record = F.from_json("value", DECLARED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": C.CORRUPT})
    others = F.map_filter(F.from_json("value", T.MapType(T.StringType(), T.StringType())), lambda k, _: ~k.isin(*schemas.RAW_COLUMNS))
    path = [c for c in lines.columns if c != "value"]
    return (lines.select("*", F.col("_metadata.file_path").alias(C.SOURCE_FILE)).filter(F.length(F.trim("value")) > 0)
            .select(record.alias("__r"), F.when(F.size(others) > 0, others).alias(C.REST), C.SOURCE_FILE, *path)
            .select("__r.*", C.REST, C.SOURCE_FILE, *path))


def read_raw(spark: SparkSession, path: str | list[str], base_path: str | None = None) -> DataFrame:
    """Batch read of raw drops.  ``path`` may be a glob or a list of hour folders (backfill, S-13)."""
    r = spark.read.option("basePath", base_path) if base_path else spark.read
    return parsed(r.text([path] if isinstance(path, str) else list(path)))


def stream_raw(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental raw source (S-3): only files not yet seen by the query's checkpoint."""
    r = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parsed(r.text(path))
