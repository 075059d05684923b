"""Zone folder layouts (K-1, K-2) and the replay-safe batch level."""

from __future__ import annotations

import glob
import os

from studylake import constants as C
from studylake.operators.normalise import accepted, normalise
from studylake.sinks.zones import write_conform, write_refine
from studylake.sources.zones import read_conform
from tests.fixtures import raw_df, sensor


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_refine_and_conform_folders(spark, tmp_dir):
    ref = accepted(normalise(raw_df(spark, [sensor(C.GYRO, "2024-01-05T10:20:00+0000", subject="S7")])))
    write_refine(ref, f"{tmp_dir}/r")
    write_conform(ref, f"{tmp_dir}/c")
    assert os.path.isdir(_local(f"{tmp_dir}/r/data_type_p_col=gyro/year_p_col=2024/month_p_col=1/day_p_col=5/hour_p_col=10"))
    assert os.path.isdir(_local(f"{tmp_dir}/c/study_type_p_col=meal_study/subject_id_p_col=S7/data_type_p_col=gyro/"
                                "year_p_col=2024/month_p_col=1/day_p_col=5"))


def test_tagged_write_replaces_its_own_folder(spark, tmp_dir):
    ref = accepted(normalise(raw_df(spark, [sensor(C.GYRO, "2024-01-05T10:20:00+0000")])))
    for _ in range(2):
        write_refine(ref, f"{tmp_dir}/r", batch_tag="q-3")
    leaf = _local(f"{tmp_dir}/r/load_batch=q-3/data_type_p_col=gyro/year_p_col=2024/month_p_col=1/day_p_col=5/hour_p_col=10")
    assert len(glob.glob(f"{leaf}/*.parquet")) == 1


def test_sparse_subjects_share_conform_folders(spark, tmp_dir):
    """F1-F3: hundreds of subjects with a record a day do not leave a folder for each of them; the rows are the same."""
    rows = [sensor(C.GYRO, f"2024-01-0{1 + i % 3}T10:20:00+0000", subject=f"S{i}") for i in range(900)]
    ref = accepted(normalise(raw_df(spark, [*rows, sensor(C.GYRO, "2024-01-01T10:20:00+0000", subject=None)])))
    write_conform(ref, f"{tmp_dir}/c")
    write_conform(ref.where("subject_id = 'S7'"), f"{tmp_dir}/c")  # a batch of one subject: a folder of its own
    assert len(glob.glob(_local(f"{tmp_dir}/c/*/*/*/*/*/*/*.parquet"))) < 60
    back = read_conform(spark, f"{tmp_dir}/c")
    want = [*(f"S{i}" for i in range(900)), "S7", None]
    assert sorted(map(str, (r[C.SUBJECT_P] for r in back.collect()))) == sorted(map(str, want))
    assert back.where(f"not {C.SUBJECT_P} <=> {C.SUBJECT_ID}").count() == 0
    own = read_conform(spark, f"{tmp_dir}/c", ["S7"])
    assert [r[C.SUBJECT_P] for r in own.collect()] == ["S7", "S7"]
    assert all("S7" in f or "~pack" in f for f in own.inputFiles())
