"""Plan shape: lookups broadcast, history pruned to the batch's hours, no Python in the plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from studylake import constants as C
from studylake.operators import facts
from studylake.operators.aggregate import affected_hours
from studylake.operators.normalise import accepted, normalise
from studylake.sinks.zones import write_refine
from studylake.sources import adapter
from studylake.sources.zones import read_refine
from tests.conftest import SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_passive_fact_lookups_are_broadcast(spark):
    ref = accepted(normalise(adapter.study_raw(spark, SF0001)))
    plan = _plan(facts.resolve_passive(ref, adapter.study_dims(spark, SF0001)))
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 8


def test_history_is_scanned_once_and_cut_to_the_batch_hours_by_a_join(spark, tmp_dir):
    ref = accepted(normalise(adapter.study_raw(spark, SF0001)))
    write_refine(ref, tmp_dir)
    hist = read_refine(spark, tmp_dir)
    out = affected_hours(ref.filter(f"{C.DAY_P} >= 29"), hist, adapter.study_dims(spark, SF0001))
    plan = _plan(out)
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and C.TYPE_P in line]
    assert len(scans) == 1 and "LeftSemi" in plan
    assert "INSET" not in plan.upper()  # no collected list of keys


def test_a_plan_counts_the_dimensions_that_it_uses_only(spark):
    ref = accepted(normalise(adapter.study_raw(spark, SF0001)))
    dims = adapter.study_dims(spark, SF0001)
    plan = _plan(facts.resolve_events(ref, dims))
    assert set(dims.row_counts) == set(facts.EVENT_DIMS)
    assert plan.count("events.parquet") == 1  # the events are read once, the calendar not at all
    facts.resolve_passive(ref, dims)
    assert set(dims.row_counts) == {*facts.EVENT_DIMS, *facts.PASSIVE_DIMS, "d_datetime"}


@pytest.mark.parametrize("name", ["passive_fact", "event_fact", "affected_hours", "reject_summary", "allocate_site"])
def test_no_python_in_plans(spark, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    assert "Python" not in plan and "ArrowEval" not in plan


def test_jobs_per_load_do_not_grow_with_groups(spark, tmp_dir):
    """Spark jobs of one fact load are the same for all hour groups and for a fifth of them."""
    from pyspark.sql import functions as F

    from studylake.operators.normalise import accepted, normalise
    from studylake.plans.jobs import init_warehouse, load_facts
    sc = spark.sparkContext
    dims = adapter.study_dims(spark, SF0001)
    dims.check_bounds()
    ref = accepted(normalise(adapter.study_raw(spark, SF0001)))
    counts, groups = [], []
    for i, part in enumerate([ref, ref.filter(F.col(C.SUBJECT_ID).isin("S0", "S1", "S2"))]):
        root = f"{tmp_dir}/wh{i}"
        init_warehouse(spark, root, dims)
        groups.append(part.select(*C.HOUR_GROUP_KEYS).distinct().count())
        sc.setJobGroup(f"load{i}-{tmp_dir}", "fact load")
        load_facts(spark, part, None, dims, root)
        sc.setJobGroup("other", "other")
        counts.append(len(sc.statusTracker().getJobIdsForGroup(f"load{i}-{tmp_dir}")))
    assert groups[0] > 2 * groups[1]
    assert counts[0] == counts[1]


def test_unbounded_dimensions_fall_back_to_shuffle_joins(spark, tmp_dir):
    """Over the broadcast bound, lookups and the allocation join are shuffle joins; same results."""
    from pyspark.sql import functions as F

    from studylake.sinks.zones import write_refine
    ref = accepted(normalise(adapter.study_raw(spark, SF0001)))
    write_refine(ref, tmp_dir)
    hist = read_refine(spark, tmp_dir)
    delta = hist.filter(F.col(C.DAY_P) >= 20)

    def rows(df, cols):
        return sorted(tuple(r) for r in df.select(*cols).collect())

    pcols = list(C.PASSIVE_KEYS) + [F.round("agg_value", 6)]
    ecols = ["evtypid", "studyid", "siteid", "subjectid", "deviceid", "mobileid", "value", "starttimestamp"]
    small = adapter.study_dims(spark, SF0001)
    want_p = rows(facts.passive_fact(facts.resolve_passive(delta, small, hist)), pcols)
    want_e = rows(facts.event_fact(facts.resolve_events(delta, small)), ecols)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        big = adapter.study_dims(spark, SF0001)
        big.max_broadcast_rows = 1
        pv = facts.resolve_passive(delta, big, hist)
        assert "SortMergeJoin" in _plan(pv) and "BroadcastHashJoin" not in _plan(pv)
        assert rows(facts.passive_fact(pv), pcols) == want_p
        assert rows(facts.event_fact(facts.resolve_events(delta, big)), ecols) == want_e
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_broadcast_bound_from_session_conf(spark):
    from studylake.dims import MAX_BROADCAST_ROWS_CONF
    try:
        spark.conf.set(MAX_BROADCAST_ROWS_CONF, "100")
        bounded = adapter.study_dims(spark, SF0001).check_bounds()
        assert bounded["d_sensor"] and not bounded["d_subject"]
    finally:
        spark.conf.unset(MAX_BROADCAST_ROWS_CONF)
    assert adapter.study_dims(spark, SF0001).check_bounds()["d_subject"]
