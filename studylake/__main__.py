"""Command line: the three jobs of the load, plus the incremental run.

    python -m studylake zones      --raw 'RAW/*/*/*/*' --refine R --conform C
    python -m studylake warehouse  --warehouse W (--dims DIR | --testdata SF_DIR)
    python -m studylake facts      --refine R --warehouse W [--since-checkpoint CKPT]
    python -m studylake incremental --raw RAW --refine R --conform C --warehouse W --checkpoint CKPT

``zones`` is M-1, ``warehouse`` is M-2 (dimension tables from a folder of
Parquet tables named like the warehouse, or derived from the test data),
``facts`` is M-3 (the whole refine zone, or with ``--since-checkpoint`` only
refine files new since the last run), ``incremental`` is M-1 + M-3 on new raw
files.  Facts and incremental read the dimensions from the warehouse.
"""

from __future__ import annotations

import argparse
import json

from studylake import schemas
from studylake.dims import Dims
from studylake.plans.jobs import ZonePaths, init_warehouse, load_facts, refine_and_conform
from studylake.session import apply_conf, build_session
from studylake.sinks import warehouse
from studylake.sinks.warehouse import read_dims
from studylake.sources.raw import read_raw
from studylake.sources.zones import read_refine
from studylake.streaming.incremental import run_incremental, run_incremental_facts


def _dims_from_folder(spark, folder: str) -> Dims:
    return Dims(**{name: schemas.conform_to(spark.read.parquet(f"{folder.rstrip('/')}/{name}"), schema)
                   for name, schema in schemas.DIMENSIONS.items()})


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="studylake")
    ap.add_argument("job", choices=["zones", "warehouse", "facts", "incremental"])
    ap.add_argument("--raw")
    ap.add_argument("--refine")
    ap.add_argument("--conform")
    ap.add_argument("--warehouse")
    ap.add_argument("--dims")
    ap.add_argument("--testdata")
    ap.add_argument("--checkpoint")
    ap.add_argument("--since-checkpoint")
    ap.add_argument("--master", default=None, help="local master for a run outside a cluster, e.g. local[8]")
    a = ap.parse_args(argv)

    if a.master:
        spark = build_session(master=a.master)
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.getOrCreate()
        apply_conf(spark)

    if a.job == "zones":
        refined = refine_and_conform(spark, read_raw(spark, a.raw), ZonePaths(a.refine, a.conform))
        refined.unpersist()
        print(json.dumps(refined.metrics))
    elif a.job == "warehouse":
        if a.testdata:
            from studylake.sources.adapter import study_dims
            dims = study_dims(spark, a.testdata)
        else:
            dims = _dims_from_folder(spark, a.dims)
        print(json.dumps(init_warehouse(spark, a.warehouse, dims)))
    elif a.job == "facts":
        dims = read_dims(spark, a.warehouse)
        if a.since_checkpoint:
            run_incremental_facts(spark, a.refine, dims, a.warehouse, a.since_checkpoint)
        else:
            refine = read_refine(spark, a.refine)
            warehouse.snapshots(spark, a.warehouse, warehouse.STATE).drop()  # the whole zone is loaded anew
            load_facts(spark, refine, None, dims, a.warehouse, batch_tag="zone")
    else:
        run_incremental(spark, a.raw, ZonePaths(a.refine, a.conform), read_dims(spark, a.warehouse), a.warehouse,
                        a.checkpoint)


if __name__ == "__main__":
    main()
