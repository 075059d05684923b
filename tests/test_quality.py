"""C-1, C-2: every key of the star schema, with a planted violation of each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from studylake import schemas
from studylake.operators.quality import star_fk_violations, star_pk_violations
from tests.fixtures import small_dims


def tables(spark):
    dims = dict(small_dims(spark).items())
    ok = {name: 1 for refs in schemas.FOREIGN_KEYS.values() for name, _ in refs}
    for fact in ("f_intentional", "f_passive"):
        rows = spark.createDataFrame([(ok, date(2024, 1, 1))], "m map<string, int>, capture_date date")
        cols = [c for c, _ in schemas.FOREIGN_KEYS[fact]]
        dims[fact] = schemas.conform_to(rows.select("capture_date", *[F.col("m")[c].alias(c) for c in cols]), schemas.FACTS[fact])
    return dims


def test_sound_tables_have_no_violation(spark):
    t = tables(spark)
    assert star_pk_violations({n: t[n] for n in schemas.PRIMARY_KEYS}).count() == 0
    assert star_fk_violations(t).count() == 0


def test_every_primary_key_is_checked(spark):
    t = tables(spark)
    broken = {}
    for name, keys in schemas.PRIMARY_KEYS.items():
        one = t[name].filter(F.col(keys[-1]) == 1)
        lost = one.withColumn(keys[-1], F.lit(None).cast("int"))
        broken[name] = t[name].unionByName(one).unionByName(one).unionByName(lost)
    got = {(r.table_name, r.key, r.rows) for r in star_pk_violations(broken).collect()}
    want = {(n, ",".join(["1"] * len(k)), 3) for n, k in schemas.PRIMARY_KEYS.items()} | {(n, ",".join(["1"] * (len(k) - 1) + ["null"]), 1) for n, k in schemas.PRIMARY_KEYS.items()}
    assert got == want


def test_every_foreign_key_is_checked_and_null_refers_to_nothing(spark):
    t = tables(spark)
    want = set()
    n = 10_000
    for name, refs in schemas.FOREIGN_KEYS.items():
        base = t[name].limit(1)
        for col, _ in refs:
            n += 1
            bad = base.withColumn(col, F.lit(n))
            t[name] = t[name].unionByName(bad).unionByName(bad).unionByName(base.withColumn(col, F.lit(None).cast("int")))
            want.add((f"{name}.{col}", n, 2))
    assert len(want) == 19
    assert {tuple(r) for r in star_fk_violations(t).collect()} == want


def test_one_aggregate_and_one_anti_join(spark):
    plan = star_fk_violations(tables(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and plan.count("Aggregate") == 1
