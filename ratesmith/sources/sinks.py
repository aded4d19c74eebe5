"""Result sinks: JDBC table overwrite and partitioned files.

The JDBC overwrite truncates the target and inserts in batches from every
partition in parallel; it is not atomic (readers can see an empty or partly
filled table while it runs).

The result is first computed into a table in the shared checkpoint folder, at
its own parallelism; only the copy from there into the database is held to a
number of connections (Spark's writer coalesces its input, which would
otherwise run the whole computation in that few tasks).

Each task's inserts are one transaction (``READ_COMMITTED``): a task that fails
before its commit leaves nothing behind.  A task that has committed but whose
executor is lost before it reports is run again and inserts its rows a second
time, so after such a loss the overwrite must be repeated;
:mod:`ratesmith.sources.publish` writes to a staging table instead, where
neither can happen.  The original deployment
wrote with ``isolationLevel=NONE`` (no transactions); pass
``isolation_level="NONE"`` to get it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratesmith.session import cut_lineage

# Write options of the overwrite (keep the table, batches of 10000 rows).
JDBC_WRITE_OPTIONS = {
    "truncate": "true",
    "batchsize": "10000",
}
DEFAULT_ISOLATION = "READ_COMMITTED"
# Concurrent connections of one overwrite: a large cluster would otherwise open
# one per partition (thousands) against a single database.  Bounds the copy into
# the database, not the computation before it.
DEFAULT_JDBC_CONNECTIONS = 32


def jdbc_properties(driver: str, user: str, password: str,
                    isolation_level: str = DEFAULT_ISOLATION, **extra: str) -> dict[str, str]:
    props = {"driver": driver, "user": user, "password": password, **JDBC_WRITE_OPTIONS,
             "isolationLevel": isolation_level}
    props.update(extra)
    return props


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
               num_partitions: int | None = DEFAULT_JDBC_CONNECTIONS) -> None:
    """Replace the rows of ``table`` with ``df`` (the table itself is kept).

    ``num_partitions`` caps concurrent connections of the copy from the
    computed table; ``None`` writes from every partition of ``df`` itself.
    """
    props = dict(properties)
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
        df = computed_first(df)
    df.write.mode("overwrite").jdbc(url, table, properties=props)


def computed_first(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, computed with all its partitions."""
    return cut_lineage(df, "jdbc-result")


def write_files(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Write ``df`` as files, optionally in ``col=value/`` folders.

    With ``partition_by`` the rows are rebalanced on those columns first, so
    each task writes few folders; adaptive execution splits a folder that holds
    too many rows over several tasks instead of one.
    """
    writer_df = df.hint("rebalance", *partition_by) if partition_by else df
    writer = writer_df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
