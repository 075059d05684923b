"""Session settings and the shared work folder.

The pipeline pins the session time zone to UTC (raw times carry an offset, the
calendar is in UTC), keeps ANSI mode on (bad text is handled with ``try_*``
functions, never by silent casts) and relies on adaptive execution for
partition coalescing, skew splitting and runtime broadcast decisions.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Coalescing targets min(advisory size, total / parallelism); this floor only binds for small
    # shuffles.  Partitioned writes pay per output file, so a small batch spread over thousands of
    # folders should still get several writer tasks (each folder still hashes to one writer).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.ui.showConsoleProgress": "false",
}

#: Settings that change results: a session that refuses them is an error.
REQUIRED = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "studylake", **extra) -> SparkSession:
    """Local session for tests and benchmarks.  On a cluster, pass the cluster's own settings."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**SESSION_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the plans rely on, on an existing session."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings: keep the cluster's value, but never with another zone or ANSI mode
            if k in REQUIRED and spark.conf.get(k, None) != v:
                raise


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset (local tests) a fresh folder is made and set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local SparkContext
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return d
    if not sc.getCheckpointDir():
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="studylake-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared folder (one per call)."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
