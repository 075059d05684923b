"""JDBC dimension sources and warehouse sinks (S-6, S-7, S-8, K-4, K-6).

Thin wrappers over Spark's JDBC data source, for a warehouse kept in a
relational database instead of Parquet.  Columns are read by name, not by
position.  Dimension tables are small: one partition, no split column.
Credentials come from the caller's options (never from this package).

These are not exercised by the test suite: that would need a database
server or an in-process database, and this build starts neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from studylake import schemas
from studylake.dims import Dims


def read_jdbc_table(spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None,
                    columns: list[str] | None = None) -> DataFrame:
    """S-6 / S-7: a whole table; with ``columns`` only those are selected in the database (S-8)."""
    src = f"(SELECT {', '.join(columns)} FROM {table}) q" if columns else table
    return spark.read.format("jdbc").options(url=url, dbtable=src, **(options or {})).load()


def read_code_map(spark: SparkSession, url: str, table: str, id_col: str, code_col: str,
                  options: dict[str, str] | None = None) -> DataFrame:
    """S-8: the (id, code) projection of a dimension, as a DataFrame (not a driver-side map)."""
    return read_jdbc_table(spark, url, table, options, [id_col, code_col])


def read_jdbc_dims(spark: SparkSession, url: str, schema_name: str, options: dict[str, str] | None = None) -> Dims:
    """All dimensions of a JDBC warehouse, cast to the declared schemas."""
    return Dims(**{
        name: schemas.conform_to(read_jdbc_table(spark, url, f"{schema_name}.{name}", options), schema)
        for name, schema in schemas.DIMENSIONS.items()
    })


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, options: dict[str, str] | None = None,
               num_partitions: int | None = None) -> None:
    """K-4 (``mode="append"``) / K-6 (``mode="overwrite"`` with truncate, keeping the table's DDL).

    Rows are written by the executors in batches, ``num_partitions`` connections at most.
    """
    opts = {"url": url, "dbtable": table, "batchsize": "10000", **(options or {})}
    if mode == "overwrite":
        opts.setdefault("truncate", "true")
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").options(**opts).mode(mode).save()
