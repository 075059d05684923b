"""D-2 / J-9 against brute force: random periods (overlapping, open-ended), random dates."""

from __future__ import annotations

import random
from datetime import date, timedelta

from studylake.operators.allocation import allocate_site
from tests.fixtures import small_dims


def _brute(periods, key, d):
    best = None
    for aid, mob, site, study, subj, dev, start, end in periods:
        if (mob, study, subj, dev) == key and start <= d and (end is None or d <= end):
            if best is None or aid > best[0]:
                best = (aid, site)
    return best[1] if best else 0


def test_allocate_site_matches_brute_force(spark):
    rnd = random.Random(7)
    base = date(2024, 1, 1)
    periods, aid = [], 0
    for key in range(12):
        for _ in range(rnd.randint(0, 4)):
            aid += rnd.randint(1, 3)
            start = base + timedelta(days=rnd.randint(0, 40))
            end = None if rnd.random() < 0.15 else start + timedelta(days=rnd.randint(0, 15))
            periods.append((aid, key % 3 + 1, rnd.randint(1, 9), key % 2 + 1, key, 1, start, end))
    rnd.shuffle(periods)
    dims = small_dims(spark, allocations=periods)
    rows = [(k % 3 + 1, k % 2 + 1, k, 1, base + timedelta(days=rnd.randint(-3, 60))) for k in range(12) for _ in range(15)]
    df = spark.createDataFrame(rows, "mobileid int, studyid int, subjectid int, deviceid int, d date")
    got = sorted((r["mobileid"], r["studyid"], r["subjectid"], r["deviceid"], r["d"], r["siteid"])
                 for r in allocate_site(df, dims, "d").collect())
    want = sorted(r + (_brute(periods, r[:4], r[4]),) for r in rows)
    assert got == want


def _segments(spark, periods):
    from studylake import schemas
    from studylake.operators.allocation import disjoint_periods
    return disjoint_periods(spark.createDataFrame(periods, schemas.D_ALLOCATION))


def test_ten_thousand_periods_on_one_key_take_linear_work(spark):
    """Every day of the key against brute force, and the rows that the plan makes stay near periods times a logarithm."""
    rnd = random.Random(11)
    base = date(2015, 1, 1)
    periods = []
    for aid in range(10_000):
        start = base + timedelta(days=rnd.randint(0, 3000))
        end = None if aid % 499 == 0 else start + timedelta(days=int(rnd.expovariate(1 / 200)))
        periods.append((aid, 1, aid % 25, 1, 1, 1, start, end))
    got = _segments(spark, periods).collect()
    best: dict[date, tuple] = {}
    last = base + timedelta(days=6000)
    for aid, _, site, *_, start, end in periods:
        d = start
        while d <= (min(end, last) if end else last):
            best[d] = max(best.get(d, (-1, -1)), (aid, site))
            d += timedelta(days=1)
    seen = 0
    for r in got:
        d = r.seg_start
        while d <= min(r.seg_end, last):
            assert best[d] == (r.allocationid, r.siteid)
            seen, d = seen + 1, d + timedelta(days=1)
    assert seen == len(best)


def test_time_bands_cover_a_period_once_and_are_few(spark):
    from pyspark.sql import functions as F

    from studylake.operators.allocation import time_bands
    rnd = random.Random(2)
    spans = [(a, a + rnd.choice([1, 2, 3, 7, 64, rnd.randint(1, 5000)])) for a in (rnd.randint(-3000, 3000) for _ in range(200))]
    rows = spark.createDataFrame(spans, "a bigint, b bigint").select("a", "b", time_bands(F.col("a"), F.col("b"), F.lit(14)).alias("bands")).collect()
    for r in rows:
        days = [d for x in r.bands for d in range(x.band << x.level, (x.band + 1) << x.level)]
        assert sorted(days) == list(range(r.a, r.b))
        assert len(r.bands) <= 2 * (r.b - r.a).bit_length()


def test_odd_periods(spark):
    day = lambda n: date(2024, 1, n)
    periods = [(1, 1, 5, 1, 1, 1, day(5), day(5)), (2, 1, 6, 1, 1, 1, day(9), day(7)), (3, 1, 7, 1, 1, 1, None, day(9)),
               (4, 2, 8, 1, 1, 1, day(1), None), (4, 2, 9, 1, 1, 1, day(1), None)]
    assert sorted((r.mobileid, r.seg_start, r.seg_end, r.siteid) for r in _segments(spark, periods).collect()) == \
        [(1, day(5), day(5), 5), (2, day(1), date(9999, 12, 31), 9)]
    assert _segments(spark, periods[:0]).count() == 0
    far = [(2, 1, 1, 1, d) for d in (date(2023, 12, 31), day(1), date(2031, 6, 1), date(9999, 12, 31))]
    df = spark.createDataFrame(far, "mobileid int, studyid int, subjectid int, deviceid int, d date")
    assert [r.siteid for r in allocate_site(df, small_dims(spark, allocations=periods), "d").orderBy("d").collect()] == [0, 9, 9, 9]
    assert {r.siteid for r in allocate_site(df, small_dims(spark, allocations=[]), "d").collect()} == {0}
