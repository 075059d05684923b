"""Integrity checks re-aimed from database constraints (C-1, C-2).

Each returns the violating keys as a DataFrame, so a load can route or report
them; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake import schemas


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """C-1: keys held by more than one row, and rows with a NULL key part (``rows`` = how many)."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .filter((F.col("rows") > 1) | null_key))


def fk_violations(fact: DataFrame, refs: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """C-2: per foreign-key column, the non-NULL values absent from the referenced column.

    ``refs`` = [(fact column, dimension frame, dimension column)].  Output:
    (fk, value, rows).  Each check is an anti-join of the fact's distinct values
    (pre-aggregated, so a hot value costs one row) against the dimension.
    """
    parts = []
    for col, dim, dim_col in refs:
        vals = (fact.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("long").alias("value"))
                .agg(F.count(F.lit(1)).alias("rows")))
        ref = dim.select(F.col(dim_col).cast("long").alias("value"))
        parts.append(vals.join(ref, "value", "left_anti").select(F.lit(col).alias("fk"), "value", "rows"))
    return reduce(DataFrame.unionByName, parts)


def star_pk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """C-1 for every table given: (table_name, key, rows) of keys held twice or with a NULL part.

    The keys of all tables go through one aggregate, pre-aggregated on the map side, so a key that a third
    of the rows share costs one row a task."""
    keys = [df.select(F.lit(name).alias("table_name"), F.array(*[F.col(k).cast("long") for k in schemas.PRIMARY_KEYS[name]]).alias("key"))
            for name, df in tables.items()]
    found = (reduce(DataFrame.unionByName, keys).groupBy("table_name", "key").agg(F.count(F.lit(1)).alias("rows"))
             .filter((F.col("rows") > 1) | F.exists("key", lambda k: k.isNull())))
    text = F.array_join(F.transform("key", lambda k: F.coalesce(k.cast("string"), F.lit("null"))), ",")
    return found.select("table_name", text.alias("key"), "rows")


def star_fk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """C-2 for every foreign key of the tables given: (fk, value, rows) of non-NULL values absent from their dimension.

    The rows' foreign keys are unpivoted and counted per distinct value in one aggregate; the distinct values are
    anti-joined once against the ids of all dimensions."""
    held = [tables[name].select(F.explode(F.array(*[
        F.struct(F.lit(f"{name}.{col}").alias("fk"), F.lit(dim).alias("dim"), F.col(col).cast("long").alias("value")) for col, dim in refs])).alias("r")).select("r.*")
        for name, refs in schemas.FOREIGN_KEYS.items() if name in tables]
    values = reduce(DataFrame.unionByName, held).filter(F.col("value").isNotNull()).groupBy("fk", "dim", "value").agg(F.count(F.lit(1)).alias("rows"))
    dims = sorted({dim for name, refs in schemas.FOREIGN_KEYS.items() if name in tables for _, dim in refs})
    ids = reduce(DataFrame.unionByName, [tables[d].select(F.lit(d).alias("dim"), F.col(schemas.PRIMARY_KEYS[d][0]).cast("long").alias("value")) for d in dims])
    return values.join(ids, ["dim", "value"], "left_anti").select("fk", "value", "rows")
