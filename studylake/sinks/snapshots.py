"""Versioned tables on plain Parquet: data folders and a commit log (K-4, K-5, K-6).

Layout of a table::

    <table>/data/version=v<number>-<random>/[<partition>=<value>/]part-*.parquet
    <table>/_log/<number>/part-*.parquet, _SUCCESS

A write goes in three steps.  (1) The new rows are written to a version folder
of their own, which no reader knows.  (2) Its folders are counted: one *entry*
per folder (partition value, path, files, rows, bytes).  (3) The next manifest,
all entries that make up the new state, is written to the log; Spark's
``_SUCCESS`` marker comes last, and with it the commit.  Readers take the
newest manifest that has its marker.  A write that breaks off between any two
steps leaves folders that no manifest names; the next write starts from the
same state, under another version name, so a replay gives the same table.
Nothing that a reader may hold is ever overwritten, and no copy of the rows is
checkpointed: the files replaced stay until :meth:`SnapshotTable.vacuum`.

The manifest is also the table's partition index.  An upsert finds the folders
of the partitions that a batch touches by a semi-join on the manifest and reads
those folders only: history is neither listed nor scanned, and the plan is the
same for one partition or many.  What the driver holds is a list of folders to
read, as any file read needs, not keys of the data.

One writer per table at a time (a load owns its warehouse); two writers of the
same commit number are told apart by an error in :meth:`SnapshotTable.commit`.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP_VERSIONS = 3
VERSION = "version"


class SnapshotTable:
    """One table under ``path``; ``partition`` is the name of its partition column, if any."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None):
        self.spark, self.path, self.schema, self.partition = spark, path.rstrip("/"), schema, partition
        self.data, self.log = f"{self.path}/data", f"{self.path}/_log"
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        value = schema[partition].dataType if partition else T.StringType()
        self.entry_schema = T.StructType([
            T.StructField("value", value), T.StructField("folder", T.StringType()),
            T.StructField("files", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("bytes", T.LongType())])

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, folder: str) -> list[str]:
        p = self._hadoop(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    # -- reading --------------------------------------------------------------

    def commits(self) -> list[int]:
        """Numbers of the complete manifests, oldest first."""
        return sorted(int(n) for n in self._names(self.log) if n.isdigit() and self._fs.exists(self._hadoop(f"{self.log}/{n}/_SUCCESS")))

    def newest(self) -> int | None:
        return max(self.commits(), default=None)

    def entries(self, number: int | None = None) -> DataFrame:
        """The manifest: one row per live folder (empty before the first commit)."""
        number = self.newest() if number is None else number
        if number is None:
            return self.spark.createDataFrame([], self.entry_schema)
        return self.spark.read.schema(self.entry_schema).parquet(f"{self.log}/{number}")

    def exists(self) -> bool:
        return self.newest() is not None

    def read(self, entries: DataFrame | None = None) -> DataFrame:
        """The rows of the newest commit, or of the given entries of a manifest only."""
        entries = self.entries() if entries is None else entries
        return self.read_folders([r.folder for r in entries.select("folder").collect()])

    def read_folders(self, folders: list[str]) -> DataFrame:
        names = self.schema.fieldNames()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        # partition columns of the path come after the data columns, `version` among them
        return (self.spark.read.schema(self.schema).option("basePath", self.data)
                .parquet(*[f"{self.data}/{f}" for f in folders]).select(*names))

    def touched(self, batch: DataFrame, number: int | None = None) -> list[str]:
        """Folders of the partitions that ``batch`` has rows of (null-safe): a semi-join on the manifest."""
        entries = self.entries(number)
        if self.partition is not None:
            values = batch.select(F.col(self.partition).alias("__value")).distinct()
            entries = entries.join(values, entries["value"].eqNullSafe(values["__value"]), "left_semi")
        return [r.folder for r in entries.select("folder").collect()]

    # -- writing --------------------------------------------------------------

    def write_version(self, df: DataFrame, number: int) -> str:
        """Step 1: the rows in a version folder of their own; its name."""
        version = f"{VERSION}=v{number:010d}-{uuid.uuid4().hex[:8]}"
        w = (df.hint("rebalance", self.partition) if self.partition else df).write.mode("errorifexists")
        (w.partitionBy(self.partition) if self.partition else w).parquet(f"{self.data}/{version}")
        return version

    def count_version(self, version: str) -> DataFrame:
        """Step 2: entries of a version folder, from file footers (no column is read)."""
        read = self.spark.read.schema(self.schema).option("basePath", self.data)
        try:
            rows = read.parquet(f"{self.data}/{version}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], self.entry_schema)
        value = F.col(self.partition) if self.partition else F.lit(None).cast("string")
        per_file = rows.groupBy(value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("n"))
        folder = F.concat(F.lit(version), F.regexp_extract("file", rf"/{VERSION}=[^/]+(.*)/[^/]+$", 1))
        return (per_file.groupBy("value", folder.alias("folder"))
                .agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"), F.sum("size").alias("bytes")).select(*self.entry_schema.fieldNames()))

    def commit(self, number: int, entries: DataFrame) -> None:
        """Step 3: the manifest; a half-written one of a broken run (no marker) is replaced."""
        path = f"{self.log}/{number}"
        if self._fs.exists(self._hadoop(f"{path}/_SUCCESS")):
            raise RuntimeError(f"commit {number} of {self.path} exists: another writer was faster")
        entries.select(*self.entry_schema.fieldNames()).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    def _change(self, df: DataFrame, base: int | None, gone: list[str] | None) -> None:
        """Commit ``df`` as new folders beside the old ones but ``gone`` (None: all of them)."""
        number = 0 if base is None else base + 1
        version = self.write_version(df, number)
        entries = self.count_version(version)
        if base is not None and gone is not None:
            old = self.entries(base)
            if gone:
                old = old.join(self.spark.createDataFrame([(f,) for f in gone], "folder string"), "folder", "left_anti")
            entries = old.select(*self.entry_schema.fieldNames()).unionByName(entries)
        self.commit(number, entries)
        if len(self.commits()) >= 2 * KEEP_VERSIONS:
            self.vacuum()

    def overwrite(self, df: DataFrame) -> None:
        """Replace all rows (an empty frame empties the table)."""
        self._change(df, self.newest(), None)

    def append(self, df: DataFrame) -> None:
        self._change(df, self.newest(), [])

    def append_new(self, df: DataFrame, key: list[str]) -> None:
        """Append the rows whose key (null-safe) is not there yet in the partitions that ``df`` touches."""
        base = self.newest()
        folders = [] if base is None else self.touched(df, base)
        if folders:
            df = df.join(*self._same(self.read_folders(folders), key), "left_anti")
        self._change(df, base, [])

    def upsert(self, df: DataFrame, key: list[str]) -> None:
        """Rows of ``df`` (one per key) replace rows of the same key; partitions without rows in ``df`` keep their folders."""
        base = self.newest()
        folders = [] if base is None else self.touched(df, base)
        merged = df
        if folders:
            merged = df.unionByName(self.read_folders(folders).join(*self._same(df, key), "left_anti"))
        self._change(merged, base, folders)

    def replace(self, df: DataFrame, value: str) -> None:
        """Rows of ``df`` become the whole content of the partition ``value``."""
        base = self.newest()
        old = [] if base is None else [r.folder for r in self.entries(base).where(F.col("value") == F.lit(value)).select("folder").collect()]
        if old or not df.isEmpty():
            self._change(df, base, old)

    @staticmethod
    def _same(other: DataFrame, key: list[str]) -> tuple[DataFrame, Column]:
        """The key of ``other`` and the condition that a row has it."""
        cond = F.lit(True)
        for c in key:
            cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
        return other.select(*[F.col(c).alias(f"__{c}") for c in key]), cond

    def compact(self, target_bytes: int) -> int:
        """Rewrite the partitions whose files could be fewer of ``target_bytes``; returns the number of folders
        replaced.  Rows do not change, and readers of older commits are not disturbed."""
        base = self.newest()
        if base is None:
            return 0
        entries = self.entries(base)
        size = entries.groupBy("value").agg(F.sum("files").alias("n"), F.sum("bytes").alias("size"))
        many = size.where(F.col("n") > F.greatest(F.ceil(F.col("size") / F.lit(target_bytes)), F.lit(1))).select(F.col("value").alias("__value"))
        folders = [r.folder for r in entries.join(many, F.col("value").eqNullSafe(F.col("__value")), "left_semi").select("folder").collect()]
        if folders:
            self._change(self.read_folders(folders), base, folders)
        return len(folders)

    def vacuum(self, keep: int = KEEP_VERSIONS) -> None:
        """Remove manifests but the newest ``keep``, and version folders that none of these names.
        Folders of a higher number than the newest commit belong to a write under way and stay."""
        commits = self.commits()
        kept = commits[-keep:]
        if not kept:
            return
        version = F.regexp_extract("folder", rf"^({VERSION}=[^/]+)", 1).alias("v")
        manifests = self.spark.read.schema(self.entry_schema).parquet(*[f"{self.log}/{n}" for n in kept])
        live = {r.v for r in manifests.select(version).distinct().collect()}
        for name in self._names(self.data):
            if name.startswith(f"{VERSION}=v") and name not in live and int(name[len(VERSION) + 2:].split("-")[0]) <= kept[-1]:
                self._fs.delete(self._hadoop(f"{self.data}/{name}"), True)
        for n in commits[:-keep]:
            self._fs.delete(self._hadoop(f"{self.log}/{n}"), True)

    def drop(self) -> None:
        """Remove the table's data and log."""
        for folder in (self.log, self.data):
            self._fs.delete(self._hadoop(folder), True)
