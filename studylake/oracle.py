"""DuckDB SQL for every registered query (the correctness oracle).

The adapter is re-derived in SQL from the same parquet tables; parsed times
are computed directly from ``ts`` (truncated to seconds), so the Spark text
round trip is checked against an independent expression.  Output
conventions: ids INTEGER, counts BIGINT, doubles rounded to 4 places, times
and dates as text.
"""

from __future__ import annotations

SENSORS = "('accelerometer', 'gyro', 'heart_rate')"
EVENTS = "('migraine', 'meal')"

BASE = f"""
WITH ev AS (
  SELECT event_id, ts, user_id, value,
    CASE event_type WHEN 'click' THEN 'accelerometer' WHEN 'view' THEN 'gyro' WHEN 'purchase' THEN 'heart_rate'
                    WHEN 'error' THEN 'migraine' WHEN 'signup' THEN 'meal' END AS data_type,
    CASE WHEN event_id % 2 = 0 THEN 'meal_study' ELSE 'migraine_study' END AS study_type,
    'S' || CAST(user_id AS VARCHAR) AS subject_id,
    'model-' || CAST(user_id % 4 AS VARCHAR) AS device_model,
    'P' || CAST(user_id % (SELECT count(*) FROM supplier) AS VARCHAR) AS phone_unique_id,
    'W' || CAST(user_id % (SELECT count(*) FROM supplier) AS VARCHAR) AS watch_unique_id,
    CASE CAST(user_id % 3 AS INTEGER) WHEN 0 THEN 0 WHEN 1 THEN -360 ELSE 330 END AS off_min,
    CASE CAST(user_id % 3 AS INTEGER) WHEN 0 THEN '+0000' WHEN 1 THEN '-0600' ELSE '+0530' END AS off_txt
  FROM events
),
raw AS (
  SELECT data_type, study_type, subject_id, device_model, phone_unique_id, watch_unique_id,
    CASE WHEN data_type IN {SENSORS} THEN 'watch' ELSE 'phone' END AS source_type,
    CASE WHEN data_type IN {SENSORS} THEN 'watch_os' ELSE 'phone_os' END AS system_name,
    '1.' || CAST(user_id % 4 AS VARCHAR) AS system_version,
    CASE WHEN data_type IN {SENSORS} THEN strftime(ts + to_minutes(off_min), '%Y-%m-%dT%H:%M:%S') || off_txt END AS measurement_time,
    CASE WHEN data_type = 'accelerometer' THEN value END AS x_acceleration,
    CASE WHEN data_type = 'accelerometer' THEN value + 1.0 END AS y_acceleration,
    CASE WHEN data_type = 'accelerometer' THEN value - 1.0 END AS z_acceleration,
    CASE WHEN data_type = 'gyro' THEN value END AS x_gyro,
    CASE WHEN data_type = 'gyro' THEN value * 2.0 END AS y_gyro,
    CASE WHEN data_type = 'gyro' THEN -value END AS z_gyro,
    CASE WHEN data_type = 'heart_rate' THEN value END AS heart_beat_count,
    CASE WHEN data_type = 'heart_rate' THEN epoch_us(ts) // 1000 END AS added_to_health_time_millis,
    CASE WHEN data_type = 'heart_rate' THEN epoch_us(ts) // 1000 + 60000 END AS data_sync_time_millis,
    CASE WHEN data_type IN {EVENTS} THEN strftime(ts + to_minutes(off_min), '%Y-%m-%dT%H:%M:%S') || off_txt END AS start_time,
    CASE WHEN data_type IN {EVENTS} THEN strftime(ts + to_minutes(off_min + 30), '%Y-%m-%dT%H:%M:%S') || off_txt END AS stop_time,
    CASE WHEN data_type = 'migraine' THEN CAST(CAST(floor(value) AS INTEGER) % 10 AS VARCHAR) END AS severity_value,
    CAST(NULL AS VARCHAR) AS _corrupt_record
  FROM ev
),
refine AS (
  SELECT data_type AS data_type_p_col, data_type, study_type, subject_id, watch_unique_id, phone_unique_id, device_model,
    CASE WHEN data_type = 'accelerometer' THEN value END AS x_acceleration,
    CASE WHEN data_type = 'accelerometer' THEN value + 1.0 END AS y_acceleration,
    CASE WHEN data_type = 'accelerometer' THEN value - 1.0 END AS z_acceleration,
    CASE WHEN data_type = 'gyro' THEN value END AS x_gyro,
    CASE WHEN data_type = 'gyro' THEN value * 2.0 END AS y_gyro,
    CASE WHEN data_type = 'gyro' THEN -value END AS z_gyro,
    CASE WHEN data_type = 'heart_rate' THEN value END AS heart_beat_count,
    CASE WHEN data_type = 'migraine' THEN CAST(CAST(floor(value) AS INTEGER) % 10 AS VARCHAR) END AS severity_value,
    CASE WHEN data_type IN {SENSORS} THEN date_trunc('second', ts) END AS measurement_time,
    CASE WHEN data_type IN {EVENTS} THEN date_trunc('second', ts) END AS start_time,
    CASE WHEN data_type IN {EVENTS} THEN date_trunc('second', ts) + INTERVAL 30 MINUTE END AS stop_time,
    date_trunc('second', ts) AS event_time,
    CAST(date_trunc('second', ts) AS DATE) AS event_date,
    CAST(year(ts) AS INTEGER) AS year_p_col, CAST(month(ts) AS INTEGER) AS month_p_col,
    CAST(day(ts) AS INTEGER) AS day_p_col, CAST(hour(ts) AS INTEGER) AS hour_p_col
  FROM ev WHERE data_type IS NOT NULL
),
d_subject AS (
  SELECT CAST(c_custkey + 1 AS INTEGER) AS subjectid, 'S' || CAST(c_custkey AS VARCHAR) AS subject_uniquecd
  FROM customer WHERE c_custkey % 7 <> 6
),
d_study AS (SELECT * FROM (VALUES (1, 'meal_study'), (2, 'migraine_study')) t(studyid, studyname)),
d_sensor AS (SELECT * FROM (VALUES (1, 'accelerometer'), (2, 'gyro'), (3, 'heart_rate')) t(sensorid, sensorname)),
d_eventtype AS (SELECT * FROM (VALUES (1, 'meal'), (2, 'migraine')) t(evtypid, evtypname)),
d_aggtype AS (SELECT * FROM (VALUES (1, 'Average'), (2, 'Existence')) t(aggtypid, aggtypename)),
d_device AS (SELECT CAST(s_suppkey + 1 AS INTEGER) AS deviceid, 'W' || CAST(s_suppkey AS VARCHAR) AS deviceuniqcd FROM supplier),
d_mobile AS (SELECT CAST(s_suppkey + 1 AS INTEGER) AS mobileid, 'P' || CAST(s_suppkey AS VARCHAR) AS mobileuniqcd FROM supplier),
d_site AS (SELECT CAST(n_nationkey + 1 AS INTEGER) AS siteid, n_name AS sitename FROM nation),
alloc_base AS (
  SELECT c_custkey, c_nationkey, s.studyid, DATE '2024-01-01' + CAST(c_custkey % 10 AS INTEGER) AS start0
  FROM customer CROSS JOIN (VALUES (1), (2)) s(studyid)
),
d_allocation AS (
  SELECT CAST((c_custkey * 2 + studyid) * 2 AS INTEGER) AS allocationid, CAST(c_custkey % (SELECT count(*) FROM supplier) + 1 AS INTEGER) AS mobileid,
         CAST(c_nationkey + 1 AS INTEGER) AS siteid, CAST(studyid AS INTEGER) AS studyid,
         CAST(c_custkey + 1 AS INTEGER) AS subjectid, CAST(c_custkey % (SELECT count(*) FROM supplier) + 1 AS INTEGER) AS deviceid,
         start0 AS startdate, start0 + 14 AS enddate
  FROM alloc_base
  UNION ALL
  SELECT CAST((c_custkey * 2 + studyid) * 2 + 1 AS INTEGER), CAST(c_custkey % (SELECT count(*) FROM supplier) + 1 AS INTEGER),
         CAST((c_nationkey + 1) % 25 + 1 AS INTEGER), CAST(studyid AS INTEGER),
         CAST(c_custkey + 1 AS INTEGER), CAST(c_custkey % (SELECT count(*) FROM supplier) + 1 AS INTEGER), start0 + 7, start0 + 20
  FROM alloc_base WHERE c_custkey % 4 = 0
),
cal_bounds AS (
  SELECT date_trunc('month', min(ts)) AS lo,
         date_trunc('month', max(ts)) + INTERVAL 1 MONTH - INTERVAL 1 HOUR AS hi
  FROM events
),
d_datetime AS (
  SELECT CAST((epoch(g.t) - epoch(b.lo)) / 3600 + 1 AS INTEGER) AS timeid,
         CAST(year(g.t) AS INTEGER) AS year, CAST(month(g.t) AS INTEGER) AS month,
         CAST(day(g.t) AS INTEGER) AS date, CAST(hour(g.t) AS INTEGER) AS hour
  FROM cal_bounds b, LATERAL (SELECT unnest(generate_series(b.lo, b.hi, INTERVAL 1 HOUR)) AS t) g
),
"""


def _site(tbl: str, date_col: str) -> str:
    return f"""COALESCE((SELECT arg_max(a.siteid, a.allocationid) FROM d_allocation a
      WHERE a.mobileid = {tbl}.mobileid AND a.studyid = {tbl}.studyid AND a.subjectid = {tbl}.subjectid
        AND a.deviceid = {tbl}.deviceid
        AND {tbl}.{date_col} BETWEEN a.startdate AND COALESCE(a.enddate, DATE '9999-12-31')), 0)"""


def _codes(t: str) -> str:
    return f"""
  LEFT JOIN (SELECT studyname, max(studyid) AS studyid FROM d_study GROUP BY 1) st ON st.studyname = {t}.study_type
  LEFT JOIN (SELECT subject_uniquecd, max(subjectid) AS subjectid FROM d_subject GROUP BY 1) su ON su.subject_uniquecd = {t}.subject_id
  LEFT JOIN (SELECT deviceuniqcd, max(deviceid) AS deviceid FROM d_device GROUP BY 1) dv ON dv.deviceuniqcd = {t}.watch_unique_id
  LEFT JOIN (SELECT mobileuniqcd, max(mobileid) AS mobileid FROM d_mobile GROUP BY 1) mo ON mo.mobileuniqcd = {t}.phone_unique_id"""


IDS = "COALESCE(st.studyid, 0) AS studyid, COALESCE(su.subjectid, 0) AS subjectid, " \
      "COALESCE(dv.deviceid, 0) AS deviceid, COALESCE(mo.mobileid, 0) AS mobileid"

KEYS = ("data_type_p_col, study_type, subject_id, watch_unique_id, phone_unique_id, "
        "year_p_col, month_p_col, day_p_col, hour_p_col")


def passive_ctes(delta: str = "refine", history: str | None = None, name: str = "p") -> str:
    """CTEs ``{name}_groups``, ``{name}_res``, ``{name}_site``: the resolved hourly groups."""
    hist = history or delta
    return f"""
{name}_cnt AS (
  SELECT {KEYS}, count(*) AS rec_count FROM {delta}
  WHERE data_type_p_col NOT IN {EVENTS} GROUP BY ALL
),
{name}_hr AS (
  SELECT {KEYS}, avg(heart_beat_count) AS mean_hr FROM {hist}
  WHERE data_type_p_col = 'heart_rate' GROUP BY ALL
),
{name}_groups AS (
  SELECT c.*, h.mean_hr FROM {name}_cnt c LEFT JOIN {name}_hr h
    ON c.data_type_p_col = h.data_type_p_col AND c.study_type IS NOT DISTINCT FROM h.study_type
   AND c.subject_id IS NOT DISTINCT FROM h.subject_id AND c.watch_unique_id IS NOT DISTINCT FROM h.watch_unique_id
   AND c.phone_unique_id IS NOT DISTINCT FROM h.phone_unique_id AND c.year_p_col = h.year_p_col
   AND c.month_p_col = h.month_p_col AND c.day_p_col = h.day_p_col AND c.hour_p_col = h.hour_p_col
),
{name}_res AS (
  SELECT g.*,
    CASE WHEN g.data_type_p_col = 'heart_rate' THEN g.mean_hr
         WHEN g.data_type_p_col IN ('accelerometer', 'gyro') THEN (CASE WHEN g.rec_count > 0 THEN 1.0 ELSE 0.0 END)
         ELSE 0.0 END AS agg_value,
    COALESCE(se.sensorid, 0) AS sensorid, COALESCE(ag.aggtypid, 0) AS aggtypid, {IDS},
    COALESCE(ca.timeid, 0) AS timeid,
    make_date(g.year_p_col, g.month_p_col, g.day_p_col) AS capture_date
  FROM {name}_groups g
  LEFT JOIN (SELECT sensorname, max(sensorid) AS sensorid FROM d_sensor GROUP BY 1) se ON se.sensorname = g.data_type_p_col
  LEFT JOIN (SELECT aggtypename, max(aggtypid) AS aggtypid FROM d_aggtype GROUP BY 1) ag
    ON ag.aggtypename = CASE WHEN g.data_type_p_col IN ('accelerometer', 'gyro') THEN 'Existence' ELSE 'Average' END
  {_codes('g')}
  LEFT JOIN (SELECT year, month, date, hour, max(timeid) AS timeid FROM d_datetime GROUP BY ALL) ca
    ON ca.year = g.year_p_col AND ca.month = g.month_p_col AND ca.date = g.day_p_col AND ca.hour = g.hour_p_col
),
{name}_site AS (
  SELECT r.*, {_site('r', 'capture_date')} AS siteid,
    CASE WHEN {_site('r', 'capture_date')} = 0 THEN 'no_allocation' WHEN r.timeid = 0 THEN 'unknown_time'
         WHEN r.sensorid = 0 THEN 'unknown_sensor' WHEN r.agg_value IS NULL THEN 'no_measurement' END AS reject_reason
  FROM {name}_res r
)"""


def event_ctes(src: str = "refine", name: str = "e") -> str:
    return f"""
{name}_res AS (
  SELECT r.*,
    CASE WHEN r.data_type_p_col = 'migraine' THEN TRY_CAST(trim(r.severity_value) AS INTEGER) ELSE -1 END AS value,
    CAST(r.start_time AS DATE) AS capture_date,
    COALESCE(et.evtypid, 0) AS evtypid, {IDS}
  FROM {src} r
  LEFT JOIN (SELECT evtypname, max(evtypid) AS evtypid FROM d_eventtype GROUP BY 1) et ON et.evtypname = r.data_type_p_col
  {_codes('r')}
  WHERE r.data_type_p_col IN {EVENTS}
),
{name}_site AS (
  SELECT x.*, {_site('x', 'capture_date')} AS siteid,
    CASE WHEN {_site('x', 'capture_date')} = 0 THEN 'no_allocation' WHEN x.evtypid = 0 THEN 'unknown_event_type'
         WHEN x.value IS NULL THEN 'bad_severity' END AS reject_reason
  FROM {name}_res x
)"""


PASSIVE_SELECT = ("aggtypid, sensorid, deviceid, subjectid, siteid, studyid, timeid, mobileid, "
                  "round(agg_value, 4) AS agg_value, strftime(capture_date, '%Y-%m-%d') AS capture_date")
EVENT_SELECT = ("evtypid, studyid, siteid, subjectid, deviceid, mobileid, value, "
                "strftime(start_time, '%Y-%m-%d %H:%M:%S') AS starttimestamp, "
                "strftime(stop_time, '%Y-%m-%d %H:%M:%S') AS endtimestamp, "
                "strftime(capture_date, '%Y-%m-%d') AS capture_date")
REJECT_ROWS = """
rej_rows AS (
  SELECT 'event' AS stage, reject_reason, mobileid, studyid, subjectid, deviceid, CAST(1 AS BIGINT) AS source_records
  FROM e_site WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT 'passive', reject_reason, mobileid, studyid, subjectid, deviceid, CAST(rec_count AS BIGINT)
  FROM p_site WHERE reject_reason IS NOT NULL
)"""
REJECT_SUMMARY = """SELECT stage, reject_reason, mobileid, studyid, subjectid, deviceid,
  count(*) AS reccount, CAST(sum(source_records) AS BIGINT) AS source_records FROM rej_rows GROUP BY ALL"""


def q(ctes: str, select: str) -> str:
    """BASE + extra CTEs (comma separated, no leading comma) + final SELECT."""
    body = BASE + (ctes.strip() + "\n" if ctes.strip() else "")
    body = body.rstrip().rstrip(",") + "\n"
    return body + select


def _ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


#: Primary key of every table as SQL (one column but for the passive fact), and its rows.
STAR_KEYS = {"d_site": ["siteid"], "d_subject": ["subjectid"], "d_mobile": ["mobileid"], "d_device": ["deviceid"], "d_sensor": ["sensorid"],
             "d_study": ["studyid"], "d_datetime": ["timeid"], "d_allocation": ["allocationid"], "d_eventtype": ["evtypid"], "d_aggtype": ["aggtypid"],
             "f_passive": ["aggtypid", "sensorid", "deviceid", "subjectid", "siteid", "studyid", "timeid", "mobileid"]}
STAR_REFS = {"d_allocation": ["mobileid", "siteid", "studyid", "subjectid", "deviceid"],
             "f_intentional": ["evtypid", "studyid", "siteid", "subjectid", "deviceid", "mobileid"],
             "f_passive": ["aggtypid", "sensorid", "deviceid", "subjectid", "siteid", "studyid", "timeid", "mobileid"]}
STAR_FACTS = event_ctes() + "," + passive_ctes() + """,
f_intentional AS (SELECT * FROM e_site WHERE reject_reason IS NULL),
f_passive AS (SELECT * FROM p_site WHERE reject_reason IS NULL)"""


def _star_pk(table: str, keys: list[str]) -> str:
    first, rest = keys[0], keys[1:]
    text = " || ',' || ".join([f"COALESCE(CAST({first} AS VARCHAR), 'null')", *[f"CAST({k} AS VARCHAR)" for k in rest]])
    cols = ", ".join(keys)
    lost = ", ".join([f"CAST(NULL AS INTEGER) AS {first}", *rest])
    return f"""SELECT '{table}' AS table_name, {text} AS key, count(*) AS rows FROM (
      SELECT {cols} FROM {table} UNION ALL SELECT {cols} FROM {table} WHERE {first} % 3 = 1
      UNION ALL SELECT {lost} FROM {table} WHERE {first} % 5 = 2) k
      GROUP BY ALL HAVING count(*) > 1 OR bool_or({first} IS NULL)"""


def _star_fk(table: str, col: str) -> str:
    dim = next(d for d, k in STAR_KEYS.items() if k == [col])
    return f"""SELECT '{table}.{col}' AS fk, CAST(v AS BIGINT) AS value, count(*) AS rows FROM (
      SELECT {col} AS v FROM {table} UNION ALL SELECT -{col} - 1 FROM {table} WHERE subjectid % 7 = 3) k
      WHERE v NOT IN (SELECT {col} FROM {dim}) GROUP BY ALL"""


ORACLE: dict[str, str] = {
    "distinct_types": q("", "SELECT DISTINCT data_type FROM raw"),
    "route_and_prune": q("", f"""SELECT data_type, study_type, subject_id, watch_unique_id, phone_unique_id,
        x_acceleration, y_acceleration, z_acceleration, x_gyro, y_gyro, z_gyro, heart_beat_count, severity_value,
        {_ts('measurement_time')} AS measurement_time, {_ts('start_time')} AS start_time, {_ts('stop_time')} AS stop_time
        FROM refine"""),
    "parse_times": q("", f"""SELECT data_type,
        CASE WHEN data_type IN {SENSORS} OR data_type IN {EVENTS}
             THEN strftime(ts + to_minutes(off_min), '%Y-%m-%dT%H:%M:%S') || off_txt END AS raw_time,
        CASE WHEN data_type IS NOT NULL THEN {_ts("date_trunc('second', ts)")} END AS event_time,
        CASE WHEN data_type IS NOT NULL THEN CAST(year(ts) AS INTEGER) END AS year_col,
        CASE WHEN data_type IS NOT NULL THEN CAST(month(ts) AS INTEGER) END AS month_col,
        CASE WHEN data_type IS NOT NULL THEN CAST(day(ts) AS INTEGER) END AS day_col,
        CASE WHEN data_type IS NOT NULL THEN CAST(hour(ts) AS INTEGER) END AS hour_col
        FROM ev"""),
    "partition_columns": q("", """SELECT study_type AS study_type_p_col, subject_id AS subject_id_p_col,
        data_type_p_col, year_p_col, month_p_col, day_p_col, count(*) AS records FROM refine GROUP BY ALL"""),
    "trim_strings": q("", """SELECT trim('  ' || data_type || ' ') AS data_type, trim('  ' || study_type || ' ') AS study_type,
        trim('  ' || subject_id || ' ') AS subject_id, trim('  ' || watch_unique_id || ' ') AS watch_unique_id,
        trim('  ' || phone_unique_id || ' ') AS phone_unique_id, trim('  ' || device_model || ' ') AS device_model
        FROM raw"""),
    "zone_roundtrip": q("", """SELECT data_type_p_col, year_p_col, month_p_col, day_p_col, count(*) AS records,
        count(DISTINCT subject_id) AS subjects FROM refine GROUP BY ALL"""),
    "conform_roundtrip": q("", """SELECT study_type AS study_type_p_col, data_type_p_col, year_p_col, month_p_col,
        count(*) AS records, count(DISTINCT subject_id) AS subjects_ FROM refine GROUP BY ALL""").replace(
        "subjects_", "subjects"),
    "refine_per_type": q("", """SELECT data_type, subject_id,
        x_acceleration, y_acceleration, z_acceleration, x_gyro, y_gyro, z_gyro, heart_beat_count,
        CASE WHEN data_type = 'heart_rate' THEN added_to_health_time_millis END AS added_to_health_time_millis,
        CASE WHEN data_type = 'heart_rate' THEN data_sync_time_millis END AS data_sync_time_millis,
        measurement_time
        FROM raw WHERE data_type IN ('accelerometer', 'gyro', 'heart_rate')"""),
    "raw_json_scan": q("", """SELECT data_type, study_type, subject_id, watch_unique_id, phone_unique_id,
        measurement_time, start_time, stop_time, heart_beat_count, severity_value, x_acceleration, x_gyro,
        _corrupt_record FROM raw"""),
    "calendar": q("", "SELECT timeid, year, month, date, hour FROM d_datetime"),
    "resolve_keys": q("", f"""SELECT r.data_type_p_col, r.study_type, r.subject_id, r.watch_unique_id, r.phone_unique_id,
        {IDS}, COALESCE(se.sensorid, 0) AS sensorid, COALESCE(et.evtypid, 0) AS evtypid, COALESCE(ag.aggtypid, 0) AS aggtypid
        FROM refine r {_codes('r')}
        LEFT JOIN (SELECT sensorname, max(sensorid) AS sensorid FROM d_sensor GROUP BY 1) se ON se.sensorname = r.data_type_p_col
        LEFT JOIN (SELECT evtypname, max(evtypid) AS evtypid FROM d_eventtype GROUP BY 1) et ON et.evtypname = r.data_type_p_col
        LEFT JOIN (SELECT aggtypename, max(aggtypid) AS aggtypid FROM d_aggtype GROUP BY 1) ag
          ON ag.aggtypename = CASE WHEN r.data_type_p_col IN ('accelerometer', 'gyro') THEN 'Existence' ELSE 'Average' END"""),
    "resolve_time": q("", """SELECT r.data_type_p_col, r.subject_id, r.year_p_col, r.month_p_col, r.day_p_col, r.hour_p_col,
        COALESCE(c.timeid, 0) AS timeid FROM refine r
        LEFT JOIN (SELECT year, month, date, hour, max(timeid) AS timeid FROM d_datetime GROUP BY ALL) c
          ON c.year = r.year_p_col AND c.month = r.month_p_col AND c.date = r.day_p_col AND c.hour = r.hour_p_col"""),
    "dim_latest_code": q("""
subj_dups AS (
  SELECT subjectid, subject_uniquecd FROM d_subject
  UNION ALL
  SELECT CAST(2 * (c_custkey + 1) AS INTEGER), 'S' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING'
)""", "SELECT subject_uniquecd, max(subjectid) AS subjectid FROM subj_dups WHERE subject_uniquecd IS NOT NULL GROUP BY 1"),
    "dim_preview": q("", "SELECT subjectid, subject_uniquecd FROM d_subject ORDER BY subjectid LIMIT 10"),
    "allocate_site": q(f"""
ak AS (SELECT r.data_type_p_col, r.event_date AS capture_date, {IDS} FROM refine r {_codes('r')})""",
        f"""SELECT data_type_p_col, mobileid, studyid, subjectid, deviceid,
        strftime(capture_date, '%Y-%m-%d') AS capture_date, {_site('ak', 'capture_date')} AS siteid FROM ak"""),
    "group_counts": q("", f"""SELECT {KEYS}, count(*) AS rec_count FROM refine
        WHERE data_type_p_col NOT IN {EVENTS} GROUP BY ALL"""),
    "hourly_heart_rate": q("", f"""SELECT {KEYS}, round(avg(heart_beat_count), 4) AS mean_hr, count(*) AS rec_count
        FROM refine WHERE data_type_p_col = 'heart_rate' GROUP BY ALL"""),
    "affected_hours": q("""
delta AS (SELECT * FROM refine WHERE event_date > (SELECT max(event_date) FROM refine) - 3),""" + passive_ctes("delta", "refine"),
        f"SELECT {KEYS}, rec_count, round(mean_hr, 4) AS mean_hr FROM p_groups"),
    "event_fact": q(event_ctes(), f"SELECT {EVENT_SELECT} FROM e_site WHERE reject_reason IS NULL"),
    "passive_fact": q(passive_ctes(), f"SELECT {PASSIVE_SELECT} FROM p_site WHERE reject_reason IS NULL"),
    "accept_reject": q(event_ctes() + "," + passive_ctes(), """
        SELECT stage, outcome, count(*) AS rows, CAST(sum(n) AS BIGINT) AS source_records FROM (
          SELECT 'event' AS stage, COALESCE(reject_reason, 'accepted') AS outcome, CAST(1 AS BIGINT) AS n FROM e_site
          UNION ALL
          SELECT 'passive', COALESCE(reject_reason, 'accepted'), CAST(rec_count AS BIGINT) FROM p_site) u
        GROUP BY ALL"""),
    "reject_summary": q(event_ctes() + "," + passive_ctes() + "," + REJECT_ROWS, REJECT_SUMMARY),
    "allocation_errors": q(event_ctes() + "," + passive_ctes() + "," + REJECT_ROWS,
        """SELECT mobileid, studyid, subjectid, deviceid, count(*) AS reccount FROM rej_rows
        WHERE reject_reason = 'no_allocation' GROUP BY ALL"""),
    "passive_upsert": q("""
old_src AS (SELECT * FROM refine WHERE day_p_col <= 20),
new_src AS (SELECT * REPLACE (heart_beat_count + 1.0 AS heart_beat_count) FROM refine WHERE day_p_col >= 15),""" +
        passive_ctes("old_src", None, "o") + "," + passive_ctes("new_src", None, "n") + """,
o_fact AS (SELECT * FROM o_site WHERE reject_reason IS NULL),
n_fact AS (SELECT * FROM n_site WHERE reject_reason IS NULL),
merged AS (
  SELECT * FROM n_fact
  UNION ALL
  SELECT * FROM o_fact o WHERE NOT EXISTS (
    SELECT 1 FROM n_fact n WHERE n.aggtypid = o.aggtypid AND n.sensorid = o.sensorid AND n.deviceid = o.deviceid
      AND n.subjectid = o.subjectid AND n.siteid = o.siteid AND n.studyid = o.studyid AND n.timeid = o.timeid
      AND n.mobileid = o.mobileid)
)""", f"SELECT {PASSIVE_SELECT} FROM merged"),
    "event_dedup": q(event_ctes(), f"SELECT DISTINCT {EVENT_SELECT} FROM e_site WHERE reject_reason IS NULL"),
    "reject_overwrite": q("""
late AS (SELECT * FROM refine WHERE day_p_col >= 16),""" + event_ctes("late") + "," + passive_ctes("late") + "," + REJECT_ROWS,
        REJECT_SUMMARY),
    "pk_violations": q("", """SELECT mobileid, studyid, subjectid, deviceid, count(*) AS rows FROM d_allocation
        GROUP BY ALL HAVING count(*) > 1 OR mobileid IS NULL OR studyid IS NULL OR subjectid IS NULL OR deviceid IS NULL"""),
    "fk_violations": q(passive_ctes(), """SELECT fk, value, count(*) AS rows FROM (
        SELECT 'aggtypid' AS fk, CAST(aggtypid AS BIGINT) AS value FROM p_site WHERE aggtypid NOT IN (SELECT aggtypid FROM d_aggtype)
        UNION ALL SELECT 'sensorid', sensorid FROM p_site WHERE sensorid NOT IN (SELECT sensorid FROM d_sensor)
        UNION ALL SELECT 'deviceid', deviceid FROM p_site WHERE deviceid NOT IN (SELECT deviceid FROM d_device)
        UNION ALL SELECT 'subjectid', subjectid FROM p_site WHERE subjectid NOT IN (SELECT subjectid FROM d_subject)
        UNION ALL SELECT 'siteid', siteid FROM p_site WHERE siteid NOT IN (SELECT siteid FROM d_site)
        UNION ALL SELECT 'studyid', studyid FROM p_site WHERE studyid NOT IN (SELECT studyid FROM d_study)
        UNION ALL SELECT 'timeid', timeid FROM p_site WHERE timeid NOT IN (SELECT timeid FROM d_datetime)
        UNION ALL SELECT 'mobileid', mobileid FROM p_site WHERE mobileid NOT IN (SELECT mobileid FROM d_mobile)
        ) v GROUP BY ALL"""),
    "zone_profile": q("", f"""SELECT data_type_p_col AS data_type, count(*) AS records,
        {_ts('min(event_time)')} AS first_time, {_ts('max(event_time)')} AS last_time FROM refine GROUP BY 1"""),
    "static_dims": q("", """SELECT table_name, count(*) AS rows FROM (
        SELECT 'd_site' AS table_name FROM d_site UNION ALL SELECT 'd_subject' FROM d_subject
        UNION ALL SELECT 'd_mobile' FROM d_mobile UNION ALL SELECT 'd_device' FROM d_device
        UNION ALL SELECT 'd_sensor' FROM d_sensor UNION ALL SELECT 'd_study' FROM d_study
        UNION ALL SELECT 'd_datetime' FROM d_datetime UNION ALL SELECT 'd_allocation' FROM d_allocation
        UNION ALL SELECT 'd_eventtype' FROM d_eventtype UNION ALL SELECT 'd_aggtype' FROM d_aggtype) t GROUP BY 1"""),
    "star_pk_violations": q(STAR_FACTS, " UNION ALL ".join(_star_pk(t, k) for t, k in STAR_KEYS.items())),
    "star_fk_violations": q(STAR_FACTS, " UNION ALL ".join(_star_fk(t, c) for t, cols in STAR_REFS.items() for c in cols)),
    "pruned_history": q("""
delta AS (SELECT * FROM refine WHERE event_date > (SELECT max(event_date) FROM refine) - 3),""" + passive_ctes("delta", "refine"),
        f"SELECT {KEYS}, rec_count, round(mean_hr, 4) AS mean_hr FROM p_groups"),
    "crowded_segments": """WITH p AS (
        SELECT o_orderkey AS allocationid, CAST(o_custkey % 25 + 1 AS INTEGER) AS siteid, CAST(o_orderkey % 2 + 1 AS INTEGER) AS studyid,
          CAST(o_orderdate AS DATE) AS s, CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) ELSE DATE '9999-12-31' END AS e
        FROM orders),
      points AS (SELECT DISTINCT studyid, unnest([CAST(s AS DATE), CAST(e + 1 AS DATE)]) AS d FROM p),
      segs AS (SELECT studyid, d, lead(d) OVER (PARTITION BY studyid ORDER BY d) AS nxt FROM points)
      SELECT 1 AS mobileid, g.studyid, 1 AS subjectid, 1 AS deviceid, strftime(g.d, '%Y-%m-%d') AS seg_start, strftime(g.nxt - 1, '%Y-%m-%d') AS seg_end,
        arg_max(p.siteid, p.allocationid) AS siteid, CAST(max(p.allocationid) AS INTEGER) AS allocationid
      FROM segs g JOIN p ON p.studyid = g.studyid AND p.s <= g.d AND g.d <= p.e WHERE g.nxt IS NOT NULL GROUP BY g.studyid, g.d, g.nxt""",
    "quarantine_replay": q(passive_ctes(), f"SELECT {PASSIVE_SELECT} FROM p_site WHERE reject_reason IS NULL"),
    "late_rows": q(passive_ctes(), f"SELECT {PASSIVE_SELECT} FROM p_site WHERE reject_reason IS NULL"),
    "rejects_withdrawn": q("""
both_batches AS (SELECT * REPLACE (CAST(NULL AS DOUBLE) AS heart_beat_count) FROM refine UNION ALL SELECT * FROM refine WHERE day_p_col <= 15),""" +
        event_ctes("both_batches") + "," + passive_ctes("both_batches") + "," + REJECT_ROWS, REJECT_SUMMARY),
    "incremental_load": q(passive_ctes(), f"SELECT {PASSIVE_SELECT} FROM p_site WHERE reject_reason IS NULL"),
    "batch_load": q(passive_ctes(), f"SELECT {PASSIVE_SELECT} FROM p_site WHERE reject_reason IS NULL"),
    "run_rejects": q(event_ctes() + "," + passive_ctes() + "," + REJECT_ROWS, REJECT_SUMMARY),
}
