"""P-11, S-1: fields that became known after they were loaded.

A raw field that no schema declares survives in the ``rest`` map of both zones.
:func:`promote` enters it in the zone's registry with a type; from then on
:func:`with_promoted` gives it as a column of that type, for rows written
before and after, and takes it out of ``rest``.  Raw is not read again.  The
registry is a versioned table of one small row per field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake import constants as C
from studylake import schemas
from studylake.sinks.snapshots import SnapshotTable

PROMOTED = T.StructType([T.StructField("field", T.StringType()), T.StructField("type", T.StringType())])


def registry(spark: SparkSession, zone: str) -> SnapshotTable:
    return SnapshotTable(spark, f"{zone.rstrip('/')}/_promoted", PROMOTED)


def promote(spark: SparkSession, zone: str, field: str, type_: str) -> None:
    """Give a rest field of the zone a column of SQL type ``type_`` (again: changes its type)."""
    if field in {*schemas.REFINE.fieldNames(), *schemas.CONFORM.fieldNames(), *schemas.RAW_COLUMNS}:
        raise ValueError(f"{field} is a declared column")
    T.DataType.fromDDL(type_)  # raises on a type that Spark does not know
    registry(spark, zone).upsert(spark.createDataFrame([(field, type_)], PROMOTED), ["field"])


def promoted_fields(spark: SparkSession, zone: str) -> dict[str, str]:
    return {r.field: r.type for r in registry(spark, zone).read().collect()}


def with_promoted(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Rows of a zone with a typed column per promoted field; a value that its type cannot hold is NULL."""
    def column(field: str, type_: str) -> F.Column:
        text = F.try_element_at(F.col(C.REST), F.lit(field))
        nested = isinstance(T.DataType.fromDDL(type_), (T.StructType, T.ArrayType, T.MapType))
        return F.from_json(text, type_) if nested else text.try_cast(type_)

    left = F.map_filter(C.REST, lambda k, _: ~k.isin(*fields)) if fields else F.col(C.REST)
    kept = [F.col(c) for c in df.columns if c != C.REST]
    return df.select(*kept, F.when(F.size(left) > 0, left).alias(C.REST), *[column(f, t).alias(f) for f, t in sorted(fields.items())])
