"""Warehouse tables on Parquet (K-4..K-8, M-2) and their readers.

Dimensions are plain Parquet folders.  Facts, reject tables and the hourly
state are versioned tables with a commit log
(:class:`studylake.sinks.snapshots.SnapshotTable`); facts and state are
partitioned by day, and a batch reads and replaces the days it touches only:

* events (K-4) are appended after an anti-join against the batch's days, so a
  replayed batch adds nothing (D-12);
* hourly aggregates (K-5) are upserted: the batch's rows replace rows with the
  same eight ids, other rows of those days go along into the new version;
* the hourly state (R-3) is upserted per hour group and load batch, so a replay
  replaces its own partials;
* the reject tables (K-6) are overwritten, also when empty, with the rejects of
  the whole run: each micro-batch leaves its partial counts in a folder of its
  own (:class:`RunRejects`), and the tables are the sum over the run's folders.

A write that breaks off at any point leaves the table as it was.  Fact writes
carry a REBALANCE hint on the day: adaptive execution sizes the files of each
folder and splits a hot day over several tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake import constants as C
from studylake import schemas
from studylake.dims import Dims
from studylake.functions.times import capture_date_of_hour
from studylake.operators.facts import EVENT_KEY
from studylake.operators.rejects import merge_partials, retractions
from studylake.sinks.snapshots import SnapshotTable

FACT_PARTITION = "capture_date"
STATE, STATE_PARTITION = "hour_state", "state_date"
QUARANTINE, QUARANTINE_NEXT = "quarantine", "quarantine_next"
STATE_KEY = [*C.HOUR_GROUP_KEYS, C.LOAD_BATCH]


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def snapshots(spark: SparkSession, root: str, name: str) -> SnapshotTable:
    """The versioned table ``name`` of a warehouse: a fact, a reject table or the hourly state."""
    if name == STATE:
        return SnapshotTable(spark, table_path(root, name), schemas.HOUR_STATE, STATE_PARTITION)
    if name in (QUARANTINE, QUARANTINE_NEXT):
        return SnapshotTable(spark, table_path(root, name), schemas.QUARANTINE, C.LOAD_BATCH)
    schema = schemas.FACTS[name]
    return SnapshotTable(spark, table_path(root, name), schema, FACT_PARTITION if FACT_PARTITION in schema.fieldNames() else None)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table with its declared schema; of a versioned table the newest commit."""
    if name in schemas.DIMENSIONS:
        return spark.read.schema(schemas.DIMENSIONS[name]).parquet(table_path(root, name))
    table = snapshots(spark, root, name)
    if not table.exists():
        raise FileNotFoundError(f"{table.path} holds no table; create it with init_warehouse")
    return table.read()


def read_dims(spark: SparkSession, root: str) -> Dims:
    return Dims(**{name: read_table(spark, root, name) for name in schemas.DIMENSIONS})


def _write_static(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def init_warehouse(spark: SparkSession, root: str, dims: Dims) -> dict[str, str]:
    """M-2 / K-7 / K-8: (re)create every table.  Dimensions are written from ``dims``
    (seeded or derived), facts and reject tables are created empty with their schema."""
    paths = {}
    for name, df in dims.items():
        paths[name] = table_path(root, name)
        _write_static(schemas.conform_to(df, schemas.DIMENSIONS[name]), paths[name])
    for name in (STATE, QUARANTINE, QUARANTINE_NEXT):
        snapshots(spark, root, name).drop()
    for name, schema in schemas.FACTS.items():
        paths[name] = table_path(root, name)
        snapshots(spark, root, name).overwrite(spark.createDataFrame([], schema))
    return paths


def replace_dimension(spark: SparkSession, root: str, name: str, df: DataFrame) -> None:
    """Mend one dimension; facts stay.  Rows that it rejected are loaded by ``replay_quarantine``."""
    _write_static(schemas.conform_to(df, schemas.DIMENSIONS[name]), table_path(root, name))


def keep_rejected(spark: SparkSession, root: str, rows: DataFrame, batch_tag: str, name: str = QUARANTINE) -> None:
    """D-6, C-3: the rejected rows of a batch with reason and source; a replay replaces them."""
    own = schemas.conform_to(rows.withColumn(C.LOAD_BATCH, F.lit(batch_tag)), schemas.QUARANTINE)
    snapshots(spark, root, name).replace(own, batch_tag)


def append_events(spark: SparkSession, root: str, fact: DataFrame, dedup: bool = True) -> None:
    """K-4: append the event fact; with ``dedup`` rows already present (same business key) are skipped."""
    table = snapshots(spark, root, "f_intentional")
    fact = schemas.conform_to(fact, schemas.F_INTENTIONAL)
    if dedup:
        table.append_new(fact.dropDuplicates(EVENT_KEY), EVENT_KEY)
    else:
        table.append(fact)


def one_per_key(new: DataFrame) -> DataFrame:
    """In-batch duplicates of a passive key keep the highest value (deterministic)."""
    new = schemas.conform_to(new, schemas.F_PASSIVE)
    new = (new.groupBy(*C.PASSIVE_KEYS, FACT_PARTITION).agg(F.max("agg_value").alias("agg_value"))
           .withColumn("obsid", F.xxhash64(*C.PASSIVE_KEYS)))
    return schemas.conform_to(new, schemas.F_PASSIVE)


def upsert_passive(spark: SparkSession, root: str, fact: DataFrame) -> None:
    """K-5: upsert the hourly fact; only the days present in ``fact`` are read and replaced."""
    snapshots(spark, root, "f_passive").upsert(one_per_key(fact), C.PASSIVE_KEYS)


def other_state(spark: SparkSession, root: str, delta: DataFrame, batch_tag: str) -> DataFrame:
    """R-3: partial sums that other batches left for the days of ``delta`` (its own, of a run before a replay, are left out)."""
    return state_of(spark, root, delta).filter(F.col(C.LOAD_BATCH) != batch_tag)


def state_of(spark: SparkSession, root: str, groups: DataFrame) -> DataFrame:
    """R-3: partial sums of all batches for the days of some hourly groups."""
    table = snapshots(spark, root, STATE)
    days = groups.filter(F.col(C.TYPE_P) == C.HEART_RATE).select(capture_date_of_hour().alias(STATE_PARTITION))
    return table.read_folders(table.touched(days) if table.exists() else [])


def add_state(spark: SparkSession, root: str, partials: DataFrame, batch_tag: str) -> None:
    """R-3: leave a batch's partial sums; a replay replaces them."""
    own = schemas.conform_to(partials.withColumn(C.LOAD_BATCH, F.lit(batch_tag)), schemas.HOUR_STATE)
    snapshots(spark, root, STATE).upsert(own, STATE_KEY)


class RunRejects:
    """The partial reject counts of one run, one folder per micro-batch (K-6, M-6).

    ``key`` names the load (its checkpoint), so loads that share a warehouse keep apart.  A replayed
    micro-batch overwrites its own folder.  :meth:`begin` drops the previous run's folders if that
    run completed; a run that broke off is continued by the next one, whose micro-batches add to it.
    """

    def __init__(self, spark: SparkSession, root: str, key: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/reject_batches/{key}"
        self._done = self._hadoop(f"{self.path}/_completed")
        self._fs = self._done.getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def begin(self) -> "RunRejects":
        if self._fs.exists(self._done):
            self._fs.delete(self._hadoop(self.path), True)
        return self

    def complete(self) -> None:
        if self._fs.exists(self._hadoop(self.path)):
            self._fs.create(self._done, True).close()

    def _others(self, tag: str) -> DataFrame | None:
        """Partial counts of the run's other micro-batches."""
        schema = T.StructType([*schemas.PARTIAL_REJECTS.fields, T.StructField(C.LOAD_BATCH, T.StringType())])
        try:
            found = self.spark.read.schema(schema).parquet(self.path)
            found.schema
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        return found.filter(F.col(C.LOAD_BATCH) != tag).drop(C.LOAD_BATCH)

    def summary(self, partials: DataFrame, tag: str, accepted: DataFrame | None = None) -> DataFrame:
        """Leave one micro-batch's partial counts and return the summary of the run so far.

        ``accepted`` (group_id) names the hourly groups that load with this micro-batch; where the run rejected
        them before, signed counts take those rejects back."""
        partials = schemas.conform_to(partials, schemas.PARTIAL_REJECTS)
        before = None if accepted is None else self._others(tag)
        if before is not None:
            partials = partials.unionByName(schemas.conform_to(retractions(before, accepted), schemas.PARTIAL_REJECTS))
        _write_static(partials, f"{self.path}/{C.LOAD_BATCH}={tag}")
        return merge_partials(self.spark.read.schema(schemas.PARTIAL_REJECTS).parquet(self.path))


def overwrite_table(root: str, name: str, df: DataFrame) -> None:
    """K-6: replace a table's content (an empty frame empties it)."""
    snapshots(df.sparkSession, root, name).overwrite(schemas.conform_to(df, schemas.FACTS[name]))


def compact(spark: SparkSession, root: str, target_bytes: int = 128 << 20) -> dict[str, int]:
    """K-4, K-5: rewrite days of the facts whose files could be fewer; folders replaced per table."""
    return {name: snapshots(spark, root, name).compact(target_bytes) for name in ("f_intentional", "f_passive")}
