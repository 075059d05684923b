"""Allocation interval join (J-9, D-2, P-15) and the accept / reject split (J-10).

A row belongs to a site when an allocation with the same (mobile, study,
subject, device) ids holds the row's capture date, both ends inclusive; a NULL
end date means open-ended.  Where periods of one key overlap, the highest
``allocationid`` wins.

Overlaps are settled once, on the dimension side.  Every start and every day
after an end is a boundary; between two neighbouring boundaries of a key the
set of open periods does not change, so the winner on the boundary's day is the
winner of the segment.  The winner is found without comparing segments with
periods: each period is split into dyadic *time bands* (band n of level k is
days n * 2^k to (n + 1) * 2^k - 1; a period of d days needs at most two bands a
level, 2 log2 d in all), every band keeps its best period, and a boundary's day
looks up its one band per level.  Rows grow with periods times the logarithm of
their length, also for one key with all periods, and shuffle by (key, band), so
a hot key is spread over tasks.

A fact row then matches at most one segment.  The join's keys are the four ids
and a year band, so that a key with a long list of segments is searched in one
year only; the date range is a residual.  Behind the last boundary of the whole
table nothing changes, and all later years share its band.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studylake import constants as C
from studylake.dims import Dims

OPEN_END = "9999-12-31"


def time_bands(first: Column, after: Column, levels: Column) -> Column:
    """array<struct<level, band>>: the fewest dyadic bands that cover the days ``first`` up to before ``after``."""
    def at(level: Column) -> Column:
        size = F.pow(F.lit(2.0), level)
        lo, hi = F.ceil(first / size).cast("bigint"), F.floor(after / size).cast("bigint")
        # of the bands lo..hi-1 that lie in the period, the inner ones are halves of bands of the next level
        left = F.when((lo < hi) & (F.pmod(lo, F.lit(2)) == 1), lo)
        right = F.when((lo < hi) & (F.pmod(hi, F.lit(2)) == 1), hi - 1)
        bands = F.filter(F.array_distinct(F.array(left, right)), lambda b: b.isNotNull())
        return F.transform(bands, lambda b: F.struct(level.alias("level"), b.alias("band")))

    return F.flatten(F.transform(F.sequence(F.lit(0), levels), at))


def _span(allocation: DataFrame) -> Column:
    """Of the whole table, by one aggregate: the last day that is a boundary (``quiet``), and the highest level of
    time bands that a period up to there can need."""
    first = F.unix_date("startdate")
    last = F.max(F.greatest(first, F.unix_date("enddate") + 1))
    return allocation.filter(F.col("startdate").isNotNull()).select(F.struct(
        F.coalesce(last, F.lit(0)).alias("quiet"),
        F.coalesce(F.ceil(F.log2((last - F.min(first) + 2).cast("double"))), F.lit(0)).cast("int").alias("levels"))).scalar()


def disjoint_periods(allocation: DataFrame) -> DataFrame:
    """Allocation periods -> non-overlapping (key, seg_start, seg_end, siteid, allocationid) segments."""
    keys = C.ALLOCATION_KEYS
    end = F.coalesce(F.col("enddate"), F.lit(OPEN_END).cast("date"))
    a = (allocation.filter(F.col("startdate").isNotNull())
         .select(*keys, F.struct("allocationid", "siteid").alias("who"), F.unix_date("startdate").cast("bigint").alias("first"),
                 (F.unix_date(end) + 1).cast("bigint").alias("after"), _span(allocation).alias("span"))
         .filter(F.col("first") < F.col("after")))
    # all boundaries that are asked for lie up to the quiet day: bands behind it are not needed
    upto = F.least(F.col("after"), F.col("span.quiet") + 1)
    best = (a.select(*keys, "who", F.explode(time_bands(F.col("first"), upto, F.col("span.levels"))).alias("b"))
            .groupBy(*keys, F.col("b.level").alias("level"), F.col("b.band").alias("band")).agg(F.max("who").alias("who")))
    points = a.select(*keys, F.col("span.levels").alias("levels"), F.explode(F.array("first", "after")).alias("p")).distinct()
    w = Window.partitionBy(*keys).orderBy("p")
    segs = points.withColumn("nxt", F.lead("p").over(w)).filter(F.col("nxt").isNotNull())
    asked = (segs.select(*keys, "p", "nxt", F.explode(F.sequence(F.lit(0), F.col("levels"))).alias("level"))
             .withColumn("band", F.floor(F.col("p") / F.pow(F.lit(2.0), F.col("level"))).cast("bigint")))
    found = asked.join(best, [*keys, "level", "band"]).groupBy(*keys, "p", "nxt").agg(F.max("who").alias("who"))
    return found.select(*keys, F.date_from_unix_date(F.col("p").cast("int")).alias("seg_start"),
                        F.date_from_unix_date((F.col("nxt") - 1).cast("int")).alias("seg_end"),
                        F.col("who.siteid").alias("siteid"), F.col("who.allocationid").alias("allocationid"))


@contextmanager
def settled(dims: Dims) -> Iterator[None]:
    """Inside, all plans of a load share one persisted settlement of the overlaps.  May be nested."""
    if "settled" in dims._derived:
        yield
        return
    segs = dims.derived("disjoint_allocation", lambda d: disjoint_periods(d.d_allocation))
    dims.derived("settled", lambda _: segs.persist(StorageLevel.MEMORY_AND_DISK))
    try:
        yield
    finally:
        del dims._derived["settled"]
        segs.unpersist(blocking=True)


def allocate_site(df: DataFrame, dims: Dims, date_col: str, out: str = "siteid") -> DataFrame:
    """Add ``out`` = site of the allocation holding ``df[date_col]`` for the row's ids, 0 when none."""
    segs = dims.derived("disjoint_allocation", lambda d: disjoint_periods(d.d_allocation))
    quiet = F.year(F.date_from_unix_date(_span(dims.d_allocation)["quiet"])) + 1  # no boundary from this year on
    segs = segs.withColumn("__quiet", quiet)
    years = F.sequence(F.least(F.year("seg_start"), F.col("__quiet")), F.least(F.year("seg_end"), F.col("__quiet")))
    r = segs.select(*[F.col(k).alias(f"__a_{k}") for k in C.ALLOCATION_KEYS], F.explode(years).alias("__a_year"),
                    F.col("seg_start").alias("__a_start"), F.col("seg_end").alias("__a_end"), F.col("siteid").alias("__a_site"))
    left = df.withColumn("__year", F.least(F.year(date_col), quiet))
    cond = F.col("__year") == F.col("__a_year")
    for k in C.ALLOCATION_KEYS:
        cond = cond & (F.col(k) == F.col(f"__a_{k}"))
    cond = cond & F.col(date_col).between(F.col("__a_start"), F.col("__a_end"))
    joined = left.join(dims.side("d_allocation", r), cond, "left")
    return (joined.withColumn(out, F.coalesce(F.col("__a_site"), F.lit(0)).cast("int"))
            .drop("__year", *[f"__a_{k}" for k in C.ALLOCATION_KEYS], "__a_year", "__a_start", "__a_end", "__a_site"))


def split(df: DataFrame, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by the reason column (J-10, C-3): bad rows are isolated, the rest load."""
    return df.filter(F.col(reason_col).isNull()), df.filter(F.col(reason_col).isNotNull())
