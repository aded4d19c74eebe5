"""SparkSession defaults for the rate and trade jobs.

Only settings that change results or plan shape live here: UTC session time
(dates are computed from timestamps), adaptive execution (runtime broadcast of
small join sides, skew-join splitting, partition coalescing) and the lineage
cut-off folder.  Cluster sizing (executors, memory, shuffle partitions) is left
to the submitter; tests and the bench pass small values.
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings applied to every session we build.  Values are Spark defaults made
# explicit, except the time zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.exchange.reuse": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting points for a large cluster, applied only when the submitter left them
# unset and the master is not local: enough initial shuffle partitions for the
# largest shuffle (trades keyed by day and asset when the rate lookups are too
# big to broadcast: ~100 TB / 16000 = ~6 GiB per partition before skew
# splitting, spilled by the sort), which adaptive execution coalesces to
# ~256 MiB for the small rate shuffles; 256 MiB file splits.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ratesmith", extra: dict | None = None) -> SparkSession:
    """Return a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster the
    submitter sets them.  ``spark.checkpoint.dir`` is taken from the submitted
    configuration; only when it is unset (local runs, tests) a scratch folder
    is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    if not spark.sparkContext.master.startswith("local"):
        for key, value in CLUSTER_DEFAULTS.items():
            if not submitted.contains(key) and not (extra or {}).get(key):
                spark.conf.set(key, value)
    for key, value in SESSION_DEFAULTS.items():
        if not key.startswith("spark.ui."):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session: only the configured folder can be used
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return configured
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="ratesmith-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


_SCOPE: contextvars.ContextVar[str | None] = contextvars.ContextVar("ratesmith_scope", default=None)

# The tables of a session that no job scope owns lie in one folder, named by the application.  Hadoop deletes
# it when the JVM ends; what a killed JVM leaves is found by its age (sweep_lineage).
_TABLES = "tables"
_OWNED = "session-"


def _tables_root(spark: SparkSession) -> str:
    """Where all sessions of the cluster keep their tables: the configured folder itself, not Spark's own folder in it."""
    current = ensure_checkpoint_dir(spark)
    try:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # a remote session
        configured = None
    return f"{(configured or current).rstrip('/')}/{_TABLES}"


def _filesystem(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def lineage_folder(spark: SparkSession) -> str:
    """The folder that owns new lineage cuts: the current job's (:func:`lineage_scope`), else the session's.

    The session's folder is removed when its JVM ends, or by :func:`release_lineage`.
    """
    scope = _SCOPE.get()
    if scope:
        return scope
    folder = f"{_tables_root(spark)}/{_OWNED}{spark.sparkContext.applicationId}"
    fs, path = _filesystem(spark, folder)
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return folder


@contextlib.contextmanager
def lineage_scope(spark: SparkSession):
    """Folder for the lineage cuts of one job, deleted when the job is done.

    Inside the ``with`` block :func:`cut_lineage` writes under this folder;
    leaving the block removes it (the results must have been written by then:
    DataFrames read from the folder are lazy).
    """
    folder = f"{_tables_root(spark)}/job-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        fs, path = _filesystem(spark, folder)
        fs.delete(path, True)


def release_lineage(spark: SparkSession) -> None:
    """Delete the session's lineage cuts now; results that still read them must have been written."""
    fs, path = _filesystem(spark, f"{_tables_root(spark)}/{_OWNED}{spark.sparkContext.applicationId}")
    fs.delete(path, True)


def sweep_lineage(spark: SparkSession, older_than_hours: float = 72.0) -> list[str]:
    """Delete what ended jobs and killed sessions left in the checkpoint folder; returns the folders.

    A folder goes when nothing was written to it for ``older_than_hours``: give more than the longest run,
    since other applications may share the checkpoint folder.  This session's folder stays.
    """
    fs, path = _filesystem(spark, _tables_root(spark))
    if not fs.exists(path):
        return []
    latest = time.time() * 1000 - older_than_hours * 3_600_000
    own, gone = _OWNED + spark.sparkContext.applicationId, []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name == own or not name.startswith((_OWNED, "job-")):
            continue
        # each cut is a folder of its own, so the newest of them tells when the owner last wrote
        newest = max([status.getModificationTime(), *(s.getModificationTime() for s in fs.listStatus(status.getPath()))])
        if newest < latest:
            fs.delete(status.getPath(), True)
            gone.append(status.getPath().toString())
    return gone


#: Spark 4.1 and later: a step's shuffle files go when it ends (an earlier Spark ignores this).
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    The data then lives in the shared folder, not on executors, so a lost
    executor does not send Spark back through the lineage; and later filters
    on the re-read table reach its parquet scan.  (A reliable RDD checkpoint
    would compute ``df`` twice unless it were also cached.)  The table belongs to the
    :func:`lineage_folder` and is removed with it.

    The shuffle files of the step go with its end: nothing reads them again, and else they stay until the
    driver's JVM happens to collect the plan as garbage, which on a large input may be never within a job.
    """
    spark = df.sparkSession
    path = f"{lineage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.parquet(path)
