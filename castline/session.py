"""Session conventions shared by every job.

The warehouse relies on a handful of SQL settings (UTC session zone, NTZ
timestamps to match the landed Parquet, ANSI casts, dynamic partition
overwrite, AQE).  They are runtime SQL confs, so ``configure`` can apply them
to a session someone else built (e.g. a cluster driver) without a restart.
Shuffle parallelism is deliberately *not* set here: operators never hard-code
it; the cluster sizes ``spark.sql.shuffle.partitions`` / AQE advisory size.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Landed Parquet timestamps are zone-less; keep literals/casts NTZ too.
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the warehouse SQL conventions to an existing session (idempotent)."""
    for key, value in SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str = "local[8]", shuffle_partitions: int | None = 8,
                app_name: str = "castline", event_log: str | None = None) -> SparkSession:
    """Session for local runs and tests, with Spark's event log in a folder if
    one is named.  On a cluster, build the session with the platform's launcher
    and call :func:`configure` on it instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="castline-warehouse-", dir="/tmp"))
        .config("spark.driver.memory", os.environ.get("CASTLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log:
        for key, value in (("enabled", "true"), ("dir", f"file://{event_log}"), ("compress", "false"),
                           ("rolling.enabled", "false"), ("buffer.kb", "100")):
            builder = builder.config(f"spark.eventLog.{key}", value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    _ensure_checkpoint_dir(spark)
    return spark


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only where it is unset
    on a local master (tests) is a folder of our own made; on a cluster its
    executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="castline-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder for staged tables / stream
    checkpoints.  Never a machine-local folder when the cluster names one."""
    root = _ensure_checkpoint_dir(spark).rstrip("/")
    suffix = f"-{uuid.uuid4().hex[:12]}" if unique else ""
    return f"{root}/castline/{name}{suffix}"


def together(spark: SparkSession, *jobs, workers: int = 6) -> list:
    """Results of functions that submit Spark jobs of their own, which do not wait for each other's last tasks.

    All of them have ended when this returns or raises the error of the first one that failed.
    """
    with ThreadPoolExecutor(workers) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [r.result() for r in running]


#: Spark's switch for deleting a statement's shuffle files when the statement has ended.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Statements inside delete their shuffle files when they end; else these stay until the driver's garbage is collected.

    For jobs that read each result back from storage: a DataFrame that is run twice would compute its shuffles again.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def staged(df, name: str):
    """``df`` written to the shared scratch folder and read back: cuts the lineage with files that every executor can read."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
