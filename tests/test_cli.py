"""The command line runs the three jobs end to end on the sf0.001 data."""

from __future__ import annotations

from pyspark.sql import functions as F

from studylake import constants as C
from studylake.__main__ import main
from studylake.sinks import warehouse
from studylake.sources import adapter
from tests.conftest import SF0001


def test_cli_jobs(spark, tmp_dir):
    raw = adapter.study_raw(spark, SF0001).drop(C.CORRUPT)
    raw.filter(F.col(C.DATA_TYPE) == C.HEART_RATE).write.json(f"{tmp_dir}/raw/2024/01/01/00")
    wh, r, c = f"{tmp_dir}/wh", f"{tmp_dir}/refine", f"{tmp_dir}/conform"
    main(["warehouse", "--warehouse", wh, "--testdata", SF0001])
    main(["zones", "--raw", f"{tmp_dir}/raw/*/*/*/*", "--refine", r, "--conform", c])
    main(["facts", "--refine", r, "--warehouse", wh])
    fact = warehouse.read_table(spark, wh, "f_passive")
    assert fact.count() > 0 and fact.filter(F.col("sensorid") != 3).count() == 0


def test_cli_incremental(spark, tmp_dir):
    raw = adapter.study_raw(spark, SF0001).drop(C.CORRUPT)
    raw.filter(F.col(C.DATA_TYPE) == C.GYRO).write.json(f"{tmp_dir}/raw/2024/01/01/00")
    wh = f"{tmp_dir}/wh"
    main(["warehouse", "--warehouse", wh, "--testdata", SF0001])
    args = ["incremental", "--raw", f"{tmp_dir}/raw", "--refine", f"{tmp_dir}/r", "--conform", f"{tmp_dir}/c",
            "--warehouse", wh, "--checkpoint", f"{tmp_dir}/ckpt"]
    main(args)
    n = warehouse.read_table(spark, wh, "f_passive").count()
    assert n > 0
    main(args)  # nothing new: nothing changes
    assert warehouse.read_table(spark, wh, "f_passive").count() == n
