"""The star schema's dimensions as one bundle, with checked broadcast sides.

A dimension is broadcast only after a count has proven it holds at most
``max_broadcast_rows`` rows.  The count is one job for all dimensions that a
plan uses (and that were not counted before): each is scanned once and counted
with map-side partial aggregation, so only one small row per partition and
dimension is shuffled.  (A ``limit(n + 1).count()`` would look cheaper but ships
up to ``n`` rows per partition to a single task.)  Allocations count their rows
times two segments times the years of the table, as their join side is cut so.
A dimension beyond the bound is joined without a hint: the planner uses a
shuffle join, and adaptive execution may still switch to a broadcast at run
time from measured sizes, or split a skewed key.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake import schemas

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
# Session setting that overrides the bound for every bundle without code changes.
MAX_BROADCAST_ROWS_CONF = "spark.studylake.maxBroadcastRows"


def _weight(name: str) -> Column:
    """What a dimension's join side grows with besides its rows: for allocations the years of the table."""
    if name != "d_allocation":
        return F.lit(None).cast("int")
    return F.year(F.greatest("startdate", F.coalesce("enddate", "startdate")))


@dataclass
class Dims:
    d_subject: DataFrame
    d_study: DataFrame
    d_device: DataFrame
    d_mobile: DataFrame
    d_sensor: DataFrame
    d_eventtype: DataFrame
    d_aggtype: DataFrame
    d_site: DataFrame
    d_allocation: DataFrame
    d_datetime: DataFrame
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS
    _bounded: dict = field(default_factory=dict, repr=False)
    _derived: dict = field(default_factory=dict, repr=False)
    row_counts: dict = field(default_factory=dict, repr=False)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(k, getattr(self, k)) for k in schemas.DIMENSIONS]

    def check_bounds(self, names: list[str] | None = None) -> dict[str, bool]:
        """Which of the named dimensions (default: all) hold at most ``max_broadcast_rows`` rows.
        One job for those not counted yet, so a plan pays for the dimensions it uses only."""
        names = [n for n, _ in self.items()] if names is None else names
        new = [n for n in names if n not in self._bounded]
        if new:
            parts = [getattr(self, n).select(F.lit(n).alias("dim"), _weight(n).alias("w")) for n in new]
            counts = {r["dim"]: (r["n"], r["lo"], r["hi"]) for r in reduce(DataFrame.unionByName, parts)
                      .groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("lo"), F.max("w").alias("hi")).collect()}
            conf = self.d_site.sparkSession.conf.get(MAX_BROADCAST_ROWS_CONF, None)
            bound = int(conf) if conf else self.max_broadcast_rows
            for n in new:
                rows, lo, hi = counts.get(n, (0, None, None))
                self.row_counts[n] = rows
                # a join side cut into years holds at most two segments a row in each year of the table
                self._bounded[n] = rows * (1 if lo is None else 2 * (hi - lo + 2)) <= bound
        return self._bounded

    def side(self, name: str, df: DataFrame | None = None) -> DataFrame:
        """The dimension (or a frame derived from it, no larger) as a join side:
        broadcast when its bound is proven, plain otherwise."""
        df = getattr(self, name) if df is None else df
        return F.broadcast(df) if self.check_bounds([name])[name] else df

    def fresh(self) -> "Dims":
        """The same dimension frames with bounds not yet checked (re-checked on first use).
        A long-running stream takes a fresh copy per micro-batch, so a dimension that has grown
        past the bound stops being broadcast."""
        return Dims(**{name: df for name, df in self.items()}, max_broadcast_rows=self.max_broadcast_rows)

    def derived(self, key: str, build) -> DataFrame:
        """Memoise a frame derived from the dimensions (e.g. disjoint allocation periods)."""
        if key not in self._derived:
            self._derived[key] = build(self)
        return self._derived[key]
