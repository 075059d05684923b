"""Registered queries: one per operator group of the inventory.

Each takes (spark, sf_dir) and returns a DataFrame.  All read the driver's
tables through :mod:`studylake.sources.adapter`, over whole tables.  Output
conventions shared with :mod:`studylake.oracle`: ids as int, counts as
bigint, doubles rounded to 4 places, times and dates as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake import constants as C
from studylake import schemas
from studylake.dims import Dims
from studylake.functions.columns import trim_strings
from studylake.functions.times import calendar_parts, parse_raw_time
from studylake.operators import facts
from studylake.operators.aggregate import affected_hours, hourly_counts, hourly_heart_rate
from studylake.operators.allocation import allocate_site, disjoint_periods, settled
from studylake.operators.lookups import latest_code, preview, resolve_codes, resolve_time
from studylake.operators.normalise import accepted, conform_partitions, legacy_type_frames, normalise
from studylake.operators.quality import fk_violations, pk_violations, star_fk_violations, star_pk_violations
from studylake.operators.rejects import allocation_errors, reject_rows, summarise_rejects
from studylake.plans.jobs import ZonePaths, init_warehouse, load_facts, replay_quarantine, run_batch
from studylake.session import apply_conf, scratch_path
from studylake.sinks import warehouse
from studylake.sinks.zones import write_conform, write_per_type, write_refine, zone_profile
from studylake.sources import adapter
from studylake.sources.raw import read_raw
from studylake.sources.zone_index import read_hours
from studylake.sources.zones import read_conform, read_refine
from studylake.streaming.incremental import run_incremental

K = C.HOUR_GROUP_KEYS


def ts_text(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def date_text(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


def r4(c) -> F.Column:
    return F.round(c, 4)


def _prep(spark: SparkSession, sf_dir: str):
    apply_conf(spark)
    raw = adapter.study_raw(spark, sf_dir)
    return raw, accepted(normalise(raw))


def _dims(spark: SparkSession, sf_dir: str) -> Dims:
    return adapter.study_dims(spark, sf_dir)


def _event_time(df: DataFrame) -> F.Column:
    return F.coalesce(F.col(C.MEASUREMENT_TIME), F.col(C.START_TIME))


# -- routing, parsing, columns ------------------------------------------------

def q_distinct_types(spark, sf_dir):
    raw, _ = _prep(spark, sf_dir)
    return raw.select(C.DATA_TYPE).distinct()


def q_route_and_prune(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    return ref.select(
        C.DATA_TYPE, C.STUDY_TYPE, C.SUBJECT_ID, C.WATCH_ID, C.PHONE_ID,
        C.X_ACC, C.Y_ACC, C.Z_ACC, C.X_GYRO, C.Y_GYRO, C.Z_GYRO, C.HEART_BEAT, C.SEVERITY,
        ts_text(C.MEASUREMENT_TIME).alias(C.MEASUREMENT_TIME), ts_text(C.START_TIME).alias(C.START_TIME),
        ts_text(C.STOP_TIME).alias(C.STOP_TIME))


def q_parse_times(spark, sf_dir):
    raw, _ = _prep(spark, sf_dir)
    return _parse_times_frame(raw)


def _parse_times_frame(raw: DataFrame) -> DataFrame:
    text = F.when(F.col(C.DATA_TYPE).isin(*C.SENSOR_TYPES), F.col(C.MEASUREMENT_TIME)).otherwise(F.col(C.START_TIME))
    t = raw.select(C.DATA_TYPE, text.alias("raw_time")).withColumn("_t", parse_raw_time("raw_time"))
    return t.select(C.DATA_TYPE, "raw_time", ts_text("_t").alias("event_time"),
                    *[c.alias(n) for n, c in calendar_parts("_t").items()])


def q_partition_columns(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    return conform_partitions(ref).groupBy(*C.CONFORM_PARTITIONS).agg(F.count(F.lit(1)).alias("records"))


def q_trim_strings(spark, sf_dir):
    raw, _ = _prep(spark, sf_dir)
    cols = [C.DATA_TYPE, C.STUDY_TYPE, C.SUBJECT_ID, C.WATCH_ID, C.PHONE_ID, C.DEVICE_MODEL]
    padded = raw.select(*[F.concat(F.lit("  "), F.col(c), F.lit(" ")).alias(c) for c in cols], C.HEART_BEAT)
    return trim_strings(padded).drop(C.HEART_BEAT)


def q_zone_roundtrip(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    path = scratch_path(spark, "refine")
    write_refine(ref, path)
    back = read_refine(spark, path)
    return back.groupBy(C.TYPE_P, C.YEAR_P, C.MONTH_P, C.DAY_P).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct(C.SUBJECT_ID).alias("subjects"))


def q_conform_roundtrip(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    path = scratch_path(spark, "conform")
    write_conform(ref, path)
    back = read_conform(spark, path)
    return back.groupBy(C.STUDY_P, C.TYPE_P, C.YEAR_P, C.MONTH_P).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct(C.SUBJECT_P).alias("subjects"))


def q_refine_per_type(spark, sf_dir):
    raw, _ = _prep(spark, sf_dir)
    path = scratch_path(spark, "per_type")
    write_per_type(legacy_type_frames(raw), path)
    back = spark.read.schema(schemas.RAW).parquet(path)
    return back.select(C.DATA_TYPE, C.SUBJECT_ID, C.X_ACC, C.Y_ACC, C.Z_ACC, C.X_GYRO, C.Y_GYRO, C.Z_GYRO,
                       C.HEART_BEAT, C.ADDED_TO_HEALTH_MS, C.DATA_SYNC_MS, C.MEASUREMENT_TIME)


def q_raw_json_scan(spark, sf_dir):
    raw, _ = _prep(spark, sf_dir)
    path = scratch_path(spark, "raw")
    hour = F.to_timestamp(F.substring(F.coalesce(F.col(C.MEASUREMENT_TIME), F.col(C.START_TIME)), 1, 13),
                          "yyyy-MM-dd'T'HH")
    folders = {"y": F.year(hour), "m": F.month(hour), "d": F.dayofmonth(hour), "h": F.hour(hour)}
    (raw.drop(C.CORRUPT).withColumns(folders).write.mode("overwrite").partitionBy("y", "m", "d", "h").json(path))
    back = read_raw(spark, f"{path}/*/*/*/*")
    return back.select(C.DATA_TYPE, C.STUDY_TYPE, C.SUBJECT_ID, C.WATCH_ID, C.PHONE_ID, C.MEASUREMENT_TIME,
                       C.START_TIME, C.STOP_TIME, C.HEART_BEAT, C.SEVERITY, C.X_ACC, C.X_GYRO, C.CORRUPT)


# -- dimensions and lookups -----------------------------------------------------

def q_calendar(spark, sf_dir):
    return _dims(spark, sf_dir).d_datetime.select("timeid", "year", "month", "date", "hour")


def q_resolve_keys(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    df = ref.select(C.TYPE_P, C.STUDY_TYPE, C.SUBJECT_ID, C.WATCH_ID, C.PHONE_ID).withColumn(
        "aggtypename", F.when(F.col(C.TYPE_P).isin(*C.EXISTENCE_SENSORS), F.lit(C.AGG_EXISTENCE)).otherwise(F.lit(C.AGG_AVERAGE)))
    out = resolve_codes(df, dims, ["subjectid", "studyid", "deviceid", "mobileid", "sensorid", "evtypid", "aggtypid"])
    return out.drop("aggtypename")


def q_resolve_time(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    df = ref.select(C.TYPE_P, C.SUBJECT_ID, C.YEAR_P, C.MONTH_P, C.DAY_P, C.HOUR_P)
    return resolve_time(df, _dims(spark, sf_dir))


def _subjects_with_duplicates(spark, sf_dir) -> DataFrame:
    customer = adapter.table(spark, sf_dir, "customer")
    dup = customer.filter(F.col("c_mktsegment") == "BUILDING").select(
        (2 * (F.col("c_custkey") + 1)).cast("int").alias("subjectid"),
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("subject_uniquecd"))
    return adapter.subject_dim(customer).select("subjectid", "subject_uniquecd").unionByName(dup)


def q_dim_latest_code(spark, sf_dir):
    return latest_code(_subjects_with_duplicates(spark, sf_dir), "subject_uniquecd", "subjectid")


def q_dim_preview(spark, sf_dir):
    return preview(_dims(spark, sf_dir).d_subject.select("subjectid", "subject_uniquecd"), "subjectid", 10)


def q_allocate_site(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    df = resolve_codes(ref.select(C.TYPE_P, C.STUDY_TYPE, C.SUBJECT_ID, C.WATCH_ID, C.PHONE_ID,
                                  F.to_date(_event_time(ref)).alias("capture_date")),
                       dims, ["mobileid", "studyid", "subjectid", "deviceid"])
    out = allocate_site(df, dims, "capture_date")
    return out.select(C.TYPE_P, *C.ALLOCATION_KEYS, date_text("capture_date").alias("capture_date"), "siteid")


# -- aggregation and facts ----------------------------------------------------

def q_group_counts(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    return hourly_counts(ref)


def q_hourly_heart_rate(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    return hourly_heart_rate(ref).withColumn("mean_hr", r4("mean_hr"))


def last_days(ref: DataFrame, days: int = 3) -> DataFrame:
    """The late batch: refine rows of the last ``days`` capture days present (scalar subquery)."""
    d = F.to_date(_event_time(ref))
    last = ref.select(F.max(F.to_date(_event_time(ref)))).scalar()
    return ref.filter(d > F.date_sub(last, days))


def q_affected_hours(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    out = affected_hours(last_days(ref), ref, _dims(spark, sf_dir))
    return out.withColumn("mean_hr", r4("mean_hr"))


def q_pruned_history(spark, sf_dir):
    """The same, with the history in a zone of two batches, of which the index names the folders to read."""
    _, ref = _prep(spark, sf_dir)
    path = scratch_path(spark, "refine")
    for tag, part in (("a", F.col(C.DAY_P) % 2 == 0), ("b", F.col(C.DAY_P) % 2 == 1)):
        write_refine(ref.filter(part), path, tag)
    delta = last_days(ref)
    history = read_hours(spark, path, delta, [C.HEART_RATE])
    return affected_hours(delta, history).withColumn("mean_hr", r4("mean_hr"))


def q_crowded_segments(spark, sf_dir):
    """Overlapping periods settled on two keys that hold all orders as periods (D-2, J-9)."""
    apply_conf(spark)
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    periods = adapter.table(spark, sf_dir, "orders").select(
        key.alias("allocationid"), F.lit(1).alias("mobileid"), (F.col("o_custkey") % 25 + 1).alias("siteid"), (key % 2 + 1).alias("studyid"),
        F.lit(1).alias("subjectid"), F.lit(1).alias("deviceid"), day.alias("startdate"),
        F.when(key % 97 != 0, F.date_add(day, (key % 90).cast("int"))).alias("enddate"))
    segs = disjoint_periods(schemas.conform_to(periods, schemas.D_ALLOCATION))
    return segs.select(*C.ALLOCATION_KEYS, date_text("seg_start").alias("seg_start"), date_text("seg_end").alias("seg_end"), "siteid", "allocationid")


EVENT_OUT = ["evtypid", "studyid", "siteid", "subjectid", "deviceid", "mobileid", "value"]
PASSIVE_OUT = list(C.PASSIVE_KEYS)


def _event_out(df: DataFrame) -> DataFrame:
    return df.select(*EVENT_OUT, ts_text("starttimestamp").alias("starttimestamp"),
                     ts_text("endtimestamp").alias("endtimestamp"), date_text("capture_date").alias("capture_date"))


def _passive_out(df: DataFrame) -> DataFrame:
    return df.select(*PASSIVE_OUT, r4("agg_value").alias("agg_value"), date_text("capture_date").alias("capture_date"))


def q_event_fact(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    return _event_out(facts.event_fact(facts.resolve_events(ref, _dims(spark, sf_dir))))


def q_passive_fact(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    return _passive_out(facts.passive_fact(facts.resolve_passive(ref, _dims(spark, sf_dir))))


def _resolved_rejects(ref: DataFrame, dims: Dims) -> DataFrame:
    ev = facts.resolve_events(ref, dims)
    pv = facts.resolve_passive(ref, dims)
    return reject_rows(ev, "event").unionByName(reject_rows(pv, "passive", "rec_count"))


def q_accept_reject(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    ev = facts.resolve_events(ref, dims).select(F.lit("event").alias("stage"), "reject_reason",
                                                F.lit(1).cast("long").alias("n"))
    pv = facts.resolve_passive(ref, dims).select(F.lit("passive").alias("stage"), "reject_reason",
                                                 F.col("rec_count").cast("long").alias("n"))
    u = ev.unionByName(pv).withColumn("outcome", F.coalesce("reject_reason", F.lit("accepted")))
    return u.groupBy("stage", "outcome").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("source_records"))


def q_reject_summary(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    return summarise_rejects(_resolved_rejects(ref, _dims(spark, sf_dir)))


def q_allocation_errors(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    return allocation_errors(_resolved_rejects(ref, _dims(spark, sf_dir)))


def q_passive_upsert(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    root = scratch_path(spark, "wh_upsert")
    old = facts.passive_fact(facts.resolve_passive(ref.filter(F.col(C.DAY_P) <= 20), dims)).persist()
    changed = ref.filter(F.col(C.DAY_P) >= 15).withColumn(C.HEART_BEAT, F.col(C.HEART_BEAT) + 1.0)
    new = facts.passive_fact(facts.resolve_passive(changed, dims)).persist()
    warehouse.upsert_passive(spark, root, old)
    warehouse.upsert_passive(spark, root, new)
    old.unpersist()
    new.unpersist()
    return _passive_out(warehouse.read_table(spark, root, "f_passive"))


def q_event_dedup(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    root = scratch_path(spark, "wh_events")
    fact = facts.event_fact(facts.resolve_events(ref, dims)).persist()
    warehouse.append_events(spark, root, fact)
    warehouse.append_events(spark, root, fact)
    fact.unpersist()
    return _event_out(warehouse.read_table(spark, root, "f_intentional"))


def q_reject_overwrite(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    root = scratch_path(spark, "wh_rejects")
    warehouse.overwrite_table(root, "rejects", summarise_rejects(_resolved_rejects(ref, dims)))
    second = summarise_rejects(_resolved_rejects(ref.filter(F.col(C.DAY_P) >= 16), dims))
    warehouse.overwrite_table(root, "rejects", second)
    return warehouse.read_table(spark, root, "rejects")


# -- quality, profile, warehouse, incremental -------------------------------------

def q_pk_violations(spark, sf_dir):
    return pk_violations(_dims(spark, sf_dir).d_allocation, C.ALLOCATION_KEYS)


def q_fk_violations(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    pv = facts.resolve_passive(ref, dims)
    refs = [("aggtypid", dims.d_aggtype, "aggtypid"), ("sensorid", dims.d_sensor, "sensorid"),
            ("deviceid", dims.d_device, "deviceid"), ("subjectid", dims.d_subject, "subjectid"),
            ("siteid", dims.d_site, "siteid"), ("studyid", dims.d_study, "studyid"),
            ("timeid", dims.d_datetime, "timeid"), ("mobileid", dims.d_mobile, "mobileid")]
    return fk_violations(pv, refs)


def _planted_keys(df: DataFrame, key: str) -> DataFrame:
    """``df`` with some rows repeated and some whose key is lost."""
    return (df.unionByName(df.filter(F.col(key) % 3 == 1))
            .unionByName(df.filter(F.col(key) % 5 == 2).withColumn(key, F.lit(None).cast("int"))))


def _planted_refs(df: DataFrame, name: str) -> DataFrame:
    """``df`` with some rows again whose foreign keys all point nowhere."""
    broken = {c: -F.col(c) - 1 for c, _ in schemas.FOREIGN_KEYS[name]}
    row, again = (F.struct(*[cols.get(c, F.col(c)).alias(c) for c in df.columns]) for cols in ({}, broken))
    # one pass over df, which may be a whole fact
    rows = F.when(F.col("subjectid") % 7 == 3, F.array(row, again)).otherwise(F.array(row))
    return df.select(F.explode(rows).alias("r")).select("r.*")


def q_star_pk_violations(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    tables = {**dict(dims.items()), "f_passive": facts.passive_fact(facts.resolve_passive(ref, dims))}
    return star_pk_violations({name: _planted_keys(tables[name], keys[0]) for name, keys in schemas.PRIMARY_KEYS.items()})


def q_star_fk_violations(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    tables = {**dict(dims.items()), "f_intentional": facts.event_fact(facts.resolve_events(ref, dims)),
              "f_passive": facts.passive_fact(facts.resolve_passive(ref, dims))}
    return star_fk_violations({**tables, **{name: _planted_refs(tables[name], name) for name in schemas.FOREIGN_KEYS}})


def q_zone_profile(spark, sf_dir):
    _, ref = _prep(spark, sf_dir)
    p = zone_profile(ref)
    return p.select("data_type", "records", ts_text("first_time").alias("first_time"),
                    ts_text("last_time").alias("last_time"))


def q_static_dims(spark, sf_dir):
    dims = _dims(spark, sf_dir)
    root = scratch_path(spark, "wh_init")
    init_warehouse(spark, root, dims)
    parts = [warehouse.read_table(spark, root, name).select(F.lit(name).alias("table_name"))
             for name in schemas.DIMENSIONS]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))


def q_incremental_load(spark, sf_dir):
    raw, _ = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    base = scratch_path(spark, "incremental")
    raw_dir, root = f"{base}/raw", f"{base}/warehouse"
    zones = ZonePaths(refine=f"{base}/refine", conform=f"{base}/conform")
    init_warehouse(spark, root, dims)
    day = F.dayofmonth(F.to_timestamp(F.substring(F.coalesce(F.col(C.MEASUREMENT_TIME), F.col(C.START_TIME)), 1, 10)))
    for i, cond in enumerate([day <= 15, day > 15]):
        raw.filter(cond).drop(C.CORRUPT).write.mode("overwrite").json(f"{raw_dir}/drop={i}")
        run_incremental(spark, raw_dir, zones, dims, root, f"{base}/checkpoint")
    return _passive_out(warehouse.read_table(spark, root, "f_passive"))


def q_run_rejects(spark, sf_dir):
    """The rejects of one run that is loaded as two micro-batches; hourly groups cross them."""
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    root = scratch_path(spark, "wh_run_rejects")
    run = warehouse.RunRejects(spark, root, "run").begin()
    second = F.pmod(F.xxhash64(C.MEASUREMENT_TIME, C.START_TIME), F.lit(2)) == 1
    with settled(dims):
        for tag, part in (("0", ~second), ("1", second)):
            load_facts(spark, ref.filter(part), None, dims, root, run=run, batch_tag=tag)
    run.complete()
    return warehouse.read_table(spark, root, "rejects")


def q_rejects_withdrawn(spark, sf_dir):
    """A run whose second micro-batch fills hours that the first one rejected for want of a measurement: the first
    has all rows without heart rates, the second the rows of days 1-15 with them."""
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    root = scratch_path(spark, "wh_withdrawn")
    run = warehouse.RunRejects(spark, root, "run").begin()
    bare = ref.withColumn(C.HEART_BEAT, F.lit(None).cast("double"))
    with settled(dims):
        for tag, part in (("0", bare), ("1", ref.filter(F.col(C.DAY_P) <= 15))):
            load_facts(spark, part, None, dims, root, run=run, batch_tag=tag)
    run.complete()
    return warehouse.read_table(spark, root, "rejects")


def q_late_rows(spark, sf_dir):
    """Hourly means from merged partial sums: groups split over two batches, the first batch replayed at the end."""
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    root = scratch_path(spark, "wh_late")
    late = F.pmod(F.xxhash64(C.MEASUREMENT_TIME, C.START_TIME), F.lit(2)) == 1
    with settled(dims):
        for tag, part in (("0", ~late), ("1", late), ("0", ~late)):
            load_facts(spark, ref.filter(part), None, dims, root, batch_tag=tag)
    return _passive_out(warehouse.read_table(spark, root, "f_passive"))


def q_quarantine_replay(spark, sf_dir):
    """A load that knows every other subject only, then a replay of what it rejected with all subjects."""
    _, ref = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    base = scratch_path(spark, "quarantine")
    root = f"{base}/warehouse"
    fewer = dims.fresh()
    fewer.d_subject = dims.d_subject.filter(F.col("subjectid") % 2 == 0)
    load_facts(spark, ref, None, fewer, root, batch_tag="0")
    replay_quarantine(spark, ZonePaths(refine=f"{base}/refine", conform=f"{base}/conform"), dims, root)
    return _passive_out(warehouse.read_table(spark, root, "f_passive"))


def q_batch_load(spark, sf_dir):
    """M-1 and M-3 as one batch job, apart from the stream."""
    raw, _ = _prep(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    base = scratch_path(spark, "batch_load")
    root = f"{base}/warehouse"
    init_warehouse(spark, root, dims)
    run_batch(spark, raw, ZonePaths(refine=f"{base}/refine", conform=f"{base}/conform"), dims, root)
    return _passive_out(warehouse.read_table(spark, root, "f_passive"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "distinct_types": q_distinct_types,
    "route_and_prune": q_route_and_prune,
    "parse_times": q_parse_times,
    "partition_columns": q_partition_columns,
    "trim_strings": q_trim_strings,
    "zone_roundtrip": q_zone_roundtrip,
    "conform_roundtrip": q_conform_roundtrip,
    "refine_per_type": q_refine_per_type,
    "raw_json_scan": q_raw_json_scan,
    "calendar": q_calendar,
    "resolve_keys": q_resolve_keys,
    "resolve_time": q_resolve_time,
    "dim_latest_code": q_dim_latest_code,
    "dim_preview": q_dim_preview,
    "allocate_site": q_allocate_site,
    "group_counts": q_group_counts,
    "hourly_heart_rate": q_hourly_heart_rate,
    "affected_hours": q_affected_hours,
    "event_fact": q_event_fact,
    "passive_fact": q_passive_fact,
    "accept_reject": q_accept_reject,
    "reject_summary": q_reject_summary,
    "allocation_errors": q_allocation_errors,
    "passive_upsert": q_passive_upsert,
    "event_dedup": q_event_dedup,
    "reject_overwrite": q_reject_overwrite,
    "pk_violations": q_pk_violations,
    "fk_violations": q_fk_violations,
    "zone_profile": q_zone_profile,
    "static_dims": q_static_dims,
    "star_pk_violations": q_star_pk_violations,
    "star_fk_violations": q_star_fk_violations,
    "pruned_history": q_pruned_history,
    "crowded_segments": q_crowded_segments,
    "late_rows": q_late_rows,
    "rejects_withdrawn": q_rejects_withdrawn,
    "quarantine_replay": q_quarantine_replay,
    "incremental_load": q_incremental_load,
    "run_rejects": q_run_rejects,
    "batch_load": q_batch_load,
}
