"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 8): one warm-up,
then ``$BENCH_RUNS`` (default 3) timed runs, median per query.  Every run
executes the full plan into the ``noop`` sink (nothing is collected).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from studylake.catalog import QUERIES  # noqa: E402
from studylake.session import build_session  # noqa: E402

HEADLINE = [
    "passive_fact",        # M-5: hourly groups + 7 lookups + calendar + allocation interval join
    "event_fact",          # M-4
    "affected_hours",      # J-11: late batch re-aggregated over history
    "reject_summary",      # M-6: both facts' rejects
    "allocate_site",       # J-9 on every row
    "resolve_keys",        # J-1..J-7 on every row
    "group_counts",        # A-2
    "hourly_heart_rate",   # A-3
    "passive_upsert",      # K-5: two upserts into a partitioned fact
    "event_dedup",         # K-4 / D-12: append twice with dedup
    "zone_roundtrip",      # K-1 + S-2: refine write and read back
]


def fact_load_jobs(spark, sf_dir: str) -> int:
    """Spark jobs of one M-3 fact load (events append, hourly upsert, reject tables) of the whole
    batch: constant in the number of hour groups (the source system ran one per heart-rate group)."""
    from studylake.operators.normalise import accepted, normalise
    from studylake.plans.jobs import init_warehouse, load_facts
    from studylake.session import scratch_path
    from studylake.sources import adapter

    dims = adapter.study_dims(spark, sf_dir)
    dims.check_bounds()
    root = scratch_path(spark, "bench_wh")
    init_warehouse(spark, root, dims)
    sc = spark.sparkContext
    sc.setJobGroup(root, "fact load")
    load_facts(spark, accepted(normalise(adapter.study_raw(spark, sf_dir))), None, dims, root)
    sc.setJobGroup("bench", "bench")
    return len(sc.statusTracker().getJobIdsForGroup(root))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    try:
        jobs = fact_load_jobs(spark, sf_dir)
    except Exception as e:  # noqa: BLE001 - report, keep benchmarking
        jobs, errors["fact_load_jobs"] = None, str(e)[:300]
    for name in names:
        try:
            run(name)  # warm-up
            timings[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        except Exception as e:  # noqa: BLE001 - a failing query is reported as null
            timings[name], errors[name] = None, str(e)[:300]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(v for v in timings.values() if v is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "fact_load_jobs": jobs,
        "runs": runs,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
