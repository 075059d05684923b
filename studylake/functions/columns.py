"""Schema-driven column helpers (P-2, P-7, P-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column, leave the others as they are (P-7, F-1)."""
    return df.select(*[
        F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def keep_when(col: str, keep: Column) -> Column:
    """``col`` where ``keep`` holds, a typed NULL elsewhere: per-type column pruning in one shared table."""
    return F.when(keep, F.col(col)).alias(col)


def code_or_zero(c: Column | str) -> Column:
    """An unresolved code maps to id 0 (P-16)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0)).cast("int")
