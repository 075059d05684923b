"""K-4, K-5, K-6: versioned tables.  A write that breaks off between any two steps changes nothing, and its replay
gives the same table; readers resolve the newest complete manifest; old versions go."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.sinks import snapshots
from studylake.sinks.snapshots import SnapshotTable

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.IntegerType()), T.StructField("day", T.DateType())])
DAY0 = date(2024, 1, 1)


def table(spark, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, SCHEMA, "day")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(t: SnapshotTable) -> list[tuple]:
    return sorted((tuple(r) for r in t.read().collect()), key=str)


def batch(rng: random.Random, n: int, value: int) -> list[tuple]:
    keys = rng.sample(range(200), n)
    return [(k, value, None if k % 50 == 7 else DAY0 + timedelta(days=k % 9)) for k in keys]


def test_upserts_equal_a_plain_dictionary(spark, tmp_dir):
    t, plain, rng = table(spark, tmp_dir), {}, random.Random(1)
    assert not t.exists()
    for i in range(6):
        new = batch(rng, 40 if i else 150, i)
        if i == 3:
            new = [r for r in new if r[2] in (None, DAY0)]
        t.upsert(frame(spark, new), ["k", "day"])
        plain.update({(r[0], r[2]): r for r in new})
        assert rows(t) == sorted(plain.values(), key=str)
    assert t.commits() == [3, 4, 5]  # the sixth commit starts a vacuum: older manifests and the folders that only they name are gone
    live = {r.folder.split("/")[0] for n in t.commits() for r in t.entries(n).collect()}
    assert set(t._names(t.data)) == live
    assert {(r.value, r["rows"]) for r in t.entries().groupBy("value").agg(F.sum("rows").alias("rows")).collect()} == \
        {(r.day, r["n"]) for r in t.read().groupBy("day").agg(F.count("*").alias("n")).collect()}


STEPS = ["write_version", "count_version", "commit", "vacuum"]  # with one version to keep every commit is followed by a vacuum


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True], ids=["before", "after"])
def test_a_write_that_breaks_off_at_any_step_can_be_replayed(spark, tmp_dir, monkeypatch, step, after):
    monkeypatch.setattr(snapshots, "KEEP_VERSIONS", 1)
    t = table(spark, tmp_dir)
    first, second = [(k, 0, DAY0 + timedelta(days=k % 4)) for k in range(40)], [(k, 1, DAY0 + timedelta(days=k % 4)) for k in range(30, 60) if k % 4 < 2]
    t.upsert(frame(spark, first), ["k"])
    t.append(frame(spark, [(999, 9, date(2030, 1, 1))]))
    first.append((999, 9, date(2030, 1, 1)))
    want_old = rows(t)
    want_new = sorted({**{r[0]: r for r in first}, **{r[0]: r for r in second}}.values(), key=str)
    real = getattr(SnapshotTable, step)

    def broken(self, *args):
        if after:
            real(self, *args)
        raise OSError("executor lost")

    monkeypatch.setattr(SnapshotTable, step, broken)
    with pytest.raises(OSError):
        t.upsert(frame(spark, second), ["k"])
    committed = step == "vacuum" or (step == "commit" and after)
    assert rows(table(spark, tmp_dir)) == (want_new if committed else want_old)
    monkeypatch.setattr(SnapshotTable, step, real)
    again = table(spark, tmp_dir)
    again.upsert(frame(spark, second), ["k"])
    assert rows(again) == want_new
    again.vacuum(keep=1)
    assert rows(again) == want_new
    assert {n for n in again._names(again.data)} == {r.folder.split("/")[0] for r in again.entries().collect()}  # nothing is left behind


def test_a_manifest_without_its_marker_is_not_read_and_is_replaced(spark, tmp_dir):
    t = table(spark, tmp_dir)
    t.append(frame(spark, [(1, 1, DAY0)]))
    frame(spark, [(9, 9, DAY0)]).write.parquet(f"{t.log}/1")
    t._fs.delete(t._hadoop(f"{t.log}/1/_SUCCESS"), False)
    assert rows(t) == [(1, 1, DAY0)]
    t.append(frame(spark, [(2, 2, DAY0)]))
    assert t.commits() == [0, 1] and rows(t) == [(1, 1, DAY0), (2, 2, DAY0)]


def test_two_writers_of_one_commit_are_an_error(spark, tmp_dir):
    t = table(spark, tmp_dir)
    t.append(frame(spark, [(1, 1, DAY0)]))
    with pytest.raises(RuntimeError):
        t.commit(0, t.entries())


def test_appends_of_known_keys_add_nothing_and_null_keys_match(spark, tmp_dir):
    t = table(spark, tmp_dir)
    new = [(1, None, DAY0), (None, 2, DAY0), (3, 3, None)]
    for _ in range(2):
        t.append_new(frame(spark, new), ["k", "v", "day"])
    assert rows(t) == sorted(new, key=str)
    t.append(frame(spark, new[:1]))
    assert len(rows(t)) == 4


def test_only_the_touched_folders_are_read_whatever_their_number(spark, tmp_dir):
    t = table(spark, tmp_dir)
    t.append(frame(spark, [(k, 0, DAY0 + timedelta(days=k)) for k in range(60)]))
    late = frame(spark, [(k, 1, DAY0 + timedelta(days=k)) for k in (3, 59)] + [(0, 0, date(2030, 1, 1))])
    folders = t.touched(late)
    assert sorted(f.split("/")[1] for f in folders) == ["day=2024-01-04", "day=2024-02-29"]
    read = t.read_folders(folders)
    assert {f.split("/")[-2] for f in read.inputFiles()} == {"day=2024-01-04", "day=2024-02-29"}
    everything = frame(spark, [(k, 1, DAY0 + timedelta(days=k)) for k in range(60)])
    assert len(t.touched(everything)) == 60


def test_an_overwrite_with_nothing_empties_and_unpartitioned_tables_work(spark, tmp_dir):
    t = SnapshotTable(spark, tmp_dir, SCHEMA)
    t.overwrite(frame(spark, [(1, 1, DAY0)]))
    t.upsert(frame(spark, [(1, 2, DAY0), (2, 2, DAY0)]), ["k"])
    assert rows(t) == [(1, 2, DAY0), (2, 2, DAY0)]
    t.overwrite(frame(spark, []))
    assert rows(t) == []
    t.upsert(frame(spark, []), ["k"])
    assert rows(t) == []


def test_compaction_keeps_the_rows_and_bounds_the_files(spark, tmp_dir):
    t = table(spark, tmp_dir)
    for i in range(4):
        t.append(frame(spark, [(10 * i + k, i, DAY0 + timedelta(days=k % 3)) for k in range(9)]))
    t.append(frame(spark, [(99, 9, date(2025, 5, 5))]))
    want, alone = rows(t), [r.folder for r in t.entries().where("value = '2025-05-05'").collect()]
    open_reader = t.read()
    assert t.compact(1 << 20) == 12
    assert rows(t) == want == sorted((tuple(r) for r in open_reader.collect()), key=str)
    assert [(r.value, r.n) for r in t.entries().groupBy("value").agg(F.sum("files").alias("n")).orderBy("value").collect()] == \
        [(DAY0, 1), (DAY0 + timedelta(days=1), 1), (DAY0 + timedelta(days=2), 1), (date(2025, 5, 5), 1)]
    assert [r.folder for r in t.entries().where("value = '2025-05-05'").collect()] == alone  # a day of one file is left alone
    assert t.compact(1 << 20) == 0


def test_no_checkpoint_is_left_by_an_upsert(spark, tmp_dir, monkeypatch):
    from pyspark.sql import DataFrame
    from studylake import schemas
    from studylake.sinks import warehouse
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: pytest.fail("an upsert must not copy its rows"))
    fact = schemas.conform_to(spark.range(20).select(F.col("id").cast("int").alias("timeid"), F.lit(DAY0).alias("capture_date"), F.lit(1.0).alias("agg_value")), schemas.F_PASSIVE)
    for _ in range(2):
        warehouse.upsert_passive(spark, tmp_dir, fact)
    assert warehouse.read_table(spark, tmp_dir, "f_passive").count() == 20


def test_a_missing_table_is_an_error(spark, tmp_dir):
    from studylake.sinks import warehouse
    with pytest.raises(FileNotFoundError):
        warehouse.read_table(spark, f"{tmp_dir}/none", "f_passive")
    assert snapshots.KEEP_VERSIONS >= 2
