"""Publication of a result into a database table that no retried task can spoil.

Rows reach a database through Spark tasks, and a task whose inserts were committed
is run again when its executor is lost before it could report.  Here a publication

1. computes the result into a table in the shared checkpoint folder, with each row's *place*
   (partition of that table, row number): from then on every attempt at a partition
   reads the same rows with the same places,
2. copies it into a staging table of its own, one transaction a task,
3. compares the staged places with the *manifest* (rows of each partition), so that a lost
   partition stops the publication and a repeated one does not,
4. in one transaction, replaces the target's rows by the staged ones, each place once,
5. drops the staging table.

Readers of the target see the old rows or the new ones, never a mixture; a publication that
fails before step 4 leaves the target as it was.  The target itself is kept (grants, indexes).

The database is behind :class:`JdbcStore`, four small operations; any object with the same
methods will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratesmith.session import cut_lineage
from ratesmith.sources.sinks import DEFAULT_JDBC_CONNECTIONS

PART, ROW = "publish_part", "publish_row"


class PublicationError(RuntimeError):
    """The staged rows are not the computed ones; the target has not been touched."""


class TableStore(Protocol):
    """What a publication needs of a database."""

    def append(self, df: DataFrame, table: str) -> None:
        """Add the rows of ``df``, creating the table if there is none.  Tasks may run more than once."""

    def transaction(self, statements: Sequence[str]) -> None:
        """Run the statements, all or none."""

    def query(self, sql: str) -> list[tuple]:
        """The rows of a small result."""

    def quoted(self, name: str) -> str:
        """A column name as the database wants it in SQL."""


class JdbcStore:
    """A database behind Spark's JDBC source; ``properties`` as for :func:`sinks.jdbc_properties`."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str],
                 connections: int = DEFAULT_JDBC_CONNECTIONS):
        self.spark, self.url, self.properties, self.connections = spark, url, dict(properties), connections

    def append(self, df: DataFrame, table: str) -> None:
        properties = self.properties | {"numPartitions": str(self.connections)}
        df.write.mode("append").jdbc(self.url, table, properties=properties)

    def query(self, sql: str) -> list[tuple]:
        return [tuple(r) for r in self.spark.read.jdbc(self.url, f"({sql}) q", properties=self.properties).collect()]

    def _dialect(self):
        return self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)

    def quoted(self, name: str) -> str:
        return self._dialect().quoteIdentifier(name)

    def transaction(self, statements: Sequence[str]) -> None:
        jvm = self.spark._jvm
        options = {"url": self.url, "dbtable": "unused", **self.properties}
        options = jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcOptionsInWrite(
            jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(options))
        connection = self._dialect().createConnectionFactory(options).apply(-1)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for sql in statements:
                statement.executeUpdate(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()


def placed(df: DataFrame) -> DataFrame:
    """``df`` computed into the checkpoint folder, each row with its place there."""
    return cut_lineage(df.withColumns({PART: F.spark_partition_id(), ROW: F.monotonically_increasing_id()}), "publication")


def swap_statements(store: TableStore, table: str, staging: str, columns: Sequence[str],
                    replaced: str | None = None) -> list[str]:
    """The statements that put the staged rows, each place once, in the place of the target's."""
    names = ", ".join(map(store.quoted, columns))
    part, row = store.quoted(PART), store.quoted(ROW)
    once = f"SELECT {names}, ROW_NUMBER() OVER (PARTITION BY {part}, {row} ORDER BY {part}) AS publish_copy FROM {staging}"
    return [f"DELETE FROM {table}" + (f" WHERE {replaced}" if replaced else ""),
            f"INSERT INTO {table} ({names}) SELECT {names} FROM ({once}) staged WHERE publish_copy = 1"]


def publish(df: DataFrame, table: str, store: TableStore, replaced: str | None = None) -> int:
    """Replace the rows of ``table`` by those of ``df``; returns how many there are.

    ``replaced`` is the SQL condition of the target's rows that go (all by default), for
    results that only cover part of a table.  The manifest (one number a partition
    of the computed table) is what reaches the driver.
    """
    clash = {PART, ROW} & set(df.columns)
    if clash:
        raise ValueError(f"column names kept for the publication: {sorted(clash)}")
    rows = placed(df)
    manifest = {p: n for p, n in rows.groupBy(PART).agg(F.count("*")).collect()}
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    store.append(df.sparkSession.createDataFrame([], df.schema), table)  # the target must exist
    try:
        store.append(rows, staging)
        part, row = store.quoted(PART), store.quoted(ROW)
        staged = {int(p): int(n) for p, n in store.query(
            f"SELECT {part}, COUNT(DISTINCT {row}) FROM {staging} GROUP BY {part}")}
        if staged != manifest:
            wrong = sorted(p for p in manifest.keys() | staged.keys() if manifest.get(p) != staged.get(p))
            raise PublicationError(f"{table}: partitions {wrong[:10]} of {len(manifest)} are not staged as computed")
        store.transaction(swap_statements(store, table, staging, df.columns, replaced))
    finally:
        store.transaction([f"DROP TABLE IF EXISTS {staging}"])
    return sum(manifest.values())
