"""Names and fixed values of the study data model.

Column names are kept as Python constants so that every module spells them the
same way.  The values under "fixed values" must stay exactly as written: they
are the codes and formats the study data is keyed on.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results)
# ---------------------------------------------------------------------------

# Record types carried in the `data_type` field.
ACCELEROMETER = "accelerometer"
GYRO = "gyro"
HEART_RATE = "heart_rate"
MIGRAINE = "migraine"
MEAL = "meal"

# Timestamp text format of the raw drops (Spark datetime pattern language).
RAW_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZZZZ"

# Seed rows of the code dimensions whose codes carry meaning.
AGGTYPE_SEED = [(1, "Average"), (2, "Existence")]
EVENTTYPE_SEED = [(1, "meal"), (2, "migraine")]
SENSOR_SEED = [(1, "accelerometer"), (2, "gyro"), (3, "heart_rate")]
STUDY_SEED = [(1, "meal_study"), (2, "migraine_study")]

# Legacy calendar: these months, every day number 1..31, every hour 0..23.
LEGACY_CALENDAR_MONTHS = [(2019, 10), (2019, 11), (2019, 12), (2020, 1), (2020, 2), (2020, 3)]

# Value written for a meal event (it has no severity).
MEAL_EVENT_VALUE = -1

# ---------------------------------------------------------------------------
# Derived groupings
# ---------------------------------------------------------------------------

SENSOR_TYPES = (ACCELEROMETER, GYRO, HEART_RATE)
EVENT_TYPES = (MIGRAINE, MEAL)
ALL_TYPES = SENSOR_TYPES + EVENT_TYPES
EXISTENCE_SENSORS = (ACCELEROMETER, GYRO)  # aggregated as "Existence"
AGG_AVERAGE = "Average"
AGG_EXISTENCE = "Existence"

# ---------------------------------------------------------------------------
# Column names (must equal the source system's)
# ---------------------------------------------------------------------------

DATA_TYPE = "data_type"
STUDY_TYPE = "study_type"
SUBJECT_ID = "subject_id"
DEVICE_MODEL = "device_model"
PHONE_ID = "phone_unique_id"
WATCH_ID = "watch_unique_id"
SOURCE_TYPE = "source_type"
SYSTEM_NAME = "system_name"
SYSTEM_VERSION = "system_version"
MEASUREMENT_TIME = "measurement_time"
X_ACC, Y_ACC, Z_ACC = "x_acceleration", "y_acceleration", "z_acceleration"
X_GYRO, Y_GYRO, Z_GYRO = "x_gyro", "y_gyro", "z_gyro"
HEART_BEAT = "heart_beat_count"
ADDED_TO_HEALTH = "added_to_health_time"
DATA_SYNC = "data_sync_time"
ADDED_TO_HEALTH_MS = "added_to_health_time_millis"
DATA_SYNC_MS = "data_sync_time_millis"
START_TIME = "start_time"
STOP_TIME = "stop_time"
SEVERITY = "severity_value"
CORRUPT = "_corrupt_record"
# Fields of a raw record that no schema declares (field -> its text), and the file a record came from.
REST = "rest"
SOURCE_FILE = "source_file"

YEAR, MONTH, DAY, HOUR = "year_col", "month_col", "day_col", "hour_col"
TYPE_P = "data_type_p_col"
YEAR_P, MONTH_P, DAY_P, HOUR_P = "year_p_col", "month_p_col", "day_p_col", "hour_p_col"
STUDY_P, SUBJECT_P = "study_type_p_col", "subject_id_p_col"

# Columns that routing removes per type.
# Columns removed per type when routing (P-2), current job.
DROP_COLUMNS = {
    ACCELEROMETER: [X_GYRO, Y_GYRO, Z_GYRO, HEART_BEAT, START_TIME, STOP_TIME, SEVERITY],
    GYRO: [X_ACC, Y_ACC, Z_ACC, HEART_BEAT, START_TIME, STOP_TIME, SEVERITY],
    HEART_RATE: [X_ACC, Y_ACC, Z_ACC, X_GYRO, Y_GYRO, Z_GYRO, START_TIME, STOP_TIME, SEVERITY],
    MIGRAINE: [X_ACC, Y_ACC, Z_ACC, X_GYRO, Y_GYRO, Z_GYRO, MEASUREMENT_TIME, HEART_BEAT],
    MEAL: [X_ACC, Y_ACC, Z_ACC, X_GYRO, Y_GYRO, Z_GYRO, MEASUREMENT_TIME, HEART_BEAT, SEVERITY],
}

# Columns removed per type by the older three-type job (K-3 layout).
LEGACY_DROP_COLUMNS = {
    ACCELEROMETER: [X_GYRO, Y_GYRO, Z_GYRO, HEART_BEAT, ADDED_TO_HEALTH_MS, DATA_SYNC_MS],
    GYRO: [X_ACC, Y_ACC, Z_ACC, HEART_BEAT, ADDED_TO_HEALTH_MS, DATA_SYNC_MS],
    HEART_RATE: [X_ACC, Y_ACC, Z_ACC, X_GYRO, Y_GYRO, Z_GYRO],
}

REFINE_PARTITIONS = [TYPE_P, YEAR_P, MONTH_P, DAY_P, HOUR_P]
# Root folder level of incrementally loaded zones: "<stream query id>-<micro-batch id>".
LOAD_BATCH = "load_batch"
CONFORM_PARTITIONS = [STUDY_P, SUBJECT_P, TYPE_P, YEAR_P, MONTH_P, DAY_P]

# The business key of an hourly sensor group (A-2 / J-11).
HOUR_GROUP_KEYS = [TYPE_P, STUDY_TYPE, SUBJECT_ID, WATCH_ID, PHONE_ID, YEAR_P, MONTH_P, DAY_P, HOUR_P]
# The resolved key of an allocation (J-9).
ALLOCATION_KEYS = ["mobileid", "studyid", "subjectid", "deviceid"]
# The unique key of the passive fact (K-5).
PASSIVE_KEYS = ["aggtypid", "sensorid", "deviceid", "subjectid", "siteid", "studyid", "timeid", "mobileid"]

# Reject reasons (ours; the row-level account of what did not load).
R_CORRUPT = "corrupt_record"
R_UNKNOWN_TYPE = "unknown_type"
R_BAD_TIMESTAMP = "bad_timestamp"
R_NO_ALLOCATION = "no_allocation"
R_UNKNOWN_TIME = "unknown_time"
R_UNKNOWN_SENSOR = "unknown_sensor"
R_UNKNOWN_EVENT_TYPE = "unknown_event_type"
R_BAD_SEVERITY = "bad_severity"
R_NO_MEASUREMENT = "no_measurement"
