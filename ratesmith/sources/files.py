"""Readers for the rate and trade files, and table registration.

Rate files are CSV in ``asset=X/quote=Y/`` folders (a third ``exchange=``
level for the multi-exchange feed); the pair comes from the folder names by
partition discovery, so filters on ``asset`` / ``quote`` prune folders.  Every
price is read as DOUBLE: text such as ``22.1`` stays 22.1.  Rows that do not
parse keep NULLs (permissive mode), as the jobs expect.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PAIR_PARTITIONS = ("asset", "quote")

# Source layouts (fixed values).
CURRENCYLAYER_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("ast", T.StringType()),
    T.StructField("qout", T.StringType()),
    T.StructField("rate", T.DoubleType()),
])

OHLC_SCHEMA = T.StructType([
    T.StructField("Timestamp", T.DateType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
])

INVESTING_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Vol", T.StringType()),
    T.StructField("Change", T.StringType()),
])

BINANCE_TRADE_COLUMNS = ("Date(UTC)", "Pair", "Side", "Price", "Executed", "Amount", "Fee")
EXMO_TRADE_COLUMNS = ("Date/Time", "Trade ID", "Type", "Currency Pair", "Amount", "Price",
                      "Total", "Fee type", "Fee amount", "Fee %")


def _csv(spark: SparkSession, schema: T.StructType, header: bool, **options: str):
    reader = spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader


def read_currencylayer(spark: SparkSession, root: str) -> DataFrame:
    """Headerless ``date, ast, qout, rate`` under ``asset=/quote=`` folders."""
    return _csv(spark, CURRENCYLAYER_SCHEMA, header=False).csv(root)


def read_ohlc(spark: SparkSession, root: str) -> DataFrame:
    """Daily OHLC with one header line, ``asset=/quote=`` folders."""
    return _csv(spark, OHLC_SCHEMA, header=True).csv(root)


def read_crypto_rates(spark: SparkSession, root: str) -> DataFrame:
    """OHLC under ``exchange=/asset=/quote=`` folders.

    Only the ``exchange=*`` folders are read, so other folders in the same
    root (a headerless feed of another layout) neither break partition
    discovery nor leak in.
    """
    root = root.rstrip("/")
    return _csv(spark, OHLC_SCHEMA, header=True, basePath=root).csv(f"{root}/exchange=*")


def read_investing(spark: SparkSession, root: str) -> DataFrame:
    """Quoted CSV with text dates (``MM/dd/yyyy``), ``asset=/quote=`` folders."""
    return _csv(spark, INVESTING_SCHEMA, header=True, quote='"', escape='"').csv(root)


def read_trade_exports(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Header CSV trade exports (a folder or glob), every column STRING.

    With ``columns`` the names are fixed and the header line is skipped, so a
    file with a reordered or missing header cannot change the mapping.
    """
    if columns is None:
        return spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return _csv(spark, schema, header=True, enforceSchema="true").csv(path)


# ----------------------------------------------------------- catalog tables

def register_csv_table(spark: SparkSession, name: str, location: str, schema: T.StructType,
                       partition_cols: tuple[str, ...] = PAIR_PARTITIONS, header: bool = False,
                       replace: bool = False, **options: str) -> None:
    """Register a partitioned CSV folder as a catalog table and discover its partitions.

    Partition columns are STRING.  New partition folders become visible with
    :func:`refresh_partitions`.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    pcols = ", ".join(f"`{p}` STRING" for p in partition_cols)
    opts = {"header": str(header).lower(), "path": location, **options}

    opt_sql = ", ".join(f"{_sql_text(k)} {_sql_text(v)}" for k, v in opts.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, {pcols}) USING csv "
              f"OPTIONS ({opt_sql}) PARTITIONED BY ({', '.join(partition_cols)})")
    refresh_partitions(spark, name)


@dataclass(frozen=True)
class PartitionChange:
    """Partitions that a refresh added to and took from the catalogue, as (column, value) pairs."""

    added: tuple[tuple[tuple[str, str], ...], ...]
    dropped: tuple[tuple[tuple[str, str], ...], ...]


#: Partitions of one ALTER TABLE statement.
PARTITIONS_AT_ONCE = 500
# Fixed value: the folder that stands for a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _table_location(spark: SparkSession, name: str) -> tuple[str, list[str]]:
    """The folder and the partition columns of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    location = next(r.data_type for r in rows if r.col_name == "Location")
    heading = next(i for i, r in enumerate(rows) if r.col_name == "# Partition Information")
    columns = []
    for r in rows[heading + 2:]:  # the heading is followed by the columns' own heading
        if not r.col_name or r.col_name.startswith("#"):
            break
        columns.append(r.col_name)
    return location, columns


def partition_folders(spark: SparkSession, location: str, columns: Sequence[str]) -> dict[tuple, str]:
    """(column, value) pairs -> path of every partition folder; folders that are none are left out.

    Lists folders only, level by level, never the files in them.
    """
    jvm = spark.sparkContext._jvm
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    root = jvm.org.apache.hadoop.fs.Path(location)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    level: list[tuple[tuple, object]] = [((), root)]
    for column in columns:
        deeper = []
        for pairs, folder in level:
            for status in fs.listStatus(folder):
                key, _, value = status.getPath().getName().partition("=")
                if status.isDirectory() and key.lower() == column.lower() and value:
                    deeper.append((pairs + ((column, unescape(value)),), status.getPath()))
        level = deeper
    return {pairs: path.toString() for pairs, path in level}


def registered_partitions(spark: SparkSession, name: str) -> set[tuple]:
    """The partitions the catalogue has for a table, as (column, value) pairs."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    out = set()
    for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
        out.add(tuple((k, unescape(v)) for k, _, v in (part.partition("=") for part in r.partition.split("/"))))
    return out


def _sql_text(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition_sql(pairs: tuple) -> str:
    value = lambda v: "NULL" if v == NULL_PARTITION else _sql_text(v)
    return "PARTITION (" + ", ".join(f"`{c}` = {value(v)}" for c, v in pairs) + ")"


def refresh_partitions(spark: SparkSession, name: str, drop_missing: bool = False) -> PartitionChange:
    """Make partition folders added since registration visible, and tell which they are.

    The folders are compared with what the catalogue has and only the difference is sent to it, so
    that a refresh without news changes nothing (``MSCK REPAIR`` lists and sends every folder
    each time).  ``drop_missing`` also takes out partitions whose folder is gone.  The
    names of the partitions pass through the driver, no file names do.
    """
    location, columns = _table_location(spark, name)
    folders, known = partition_folders(spark, location, columns), registered_partitions(spark, name)
    added = tuple(sorted(folders.keys() - known))
    dropped = tuple(sorted(known - folders.keys())) if drop_missing else ()
    for i in range(0, len(added), PARTITIONS_AT_ONCE):
        parts = " ".join(f"{_partition_sql(p)} LOCATION {_sql_text(folders[p])}" for p in added[i:i + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    for i in range(0, len(dropped), PARTITIONS_AT_ONCE):
        parts = ", ".join(_partition_sql(p) for p in dropped[i:i + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
    if added or dropped:
        spark.catalog.refreshTable(name)
    return PartitionChange(added, dropped)


def register_rate_tables(spark: SparkSession, currencylayer_root: str | None = None,
                         ohlc_root: str | None = None, crypto_root: str | None = None,
                         investing_root: str | None = None) -> list[str]:
    """Register the rate folders that are given as catalog tables and discover their partitions.

    Tables: ``currencylayer`` (headerless), ``binance_currencies`` (OHLC),
    ``crypto_rates`` (OHLC under ``exchange=/asset=/quote=``; other folders in
    its root are not partitions and are ignored) and ``investing_currencies``
    (quoted, text dates).  A table of that name is replaced, so a changed root takes
    effect (the tables are unmanaged: no file is touched).  Returns the names registered.
    """
    done = []
    if currencylayer_root:
        register_csv_table(spark, "currencylayer", currencylayer_root, CURRENCYLAYER_SCHEMA,
                           replace=True)
        done.append("currencylayer")
    if ohlc_root:
        register_csv_table(spark, "binance_currencies", ohlc_root, OHLC_SCHEMA, header=True,
                           replace=True)
        done.append("binance_currencies")
    if crypto_root:
        register_csv_table(spark, "crypto_rates", crypto_root, OHLC_SCHEMA,
                           partition_cols=("exchange",) + PAIR_PARTITIONS, header=True, replace=True)
        done.append("crypto_rates")
    if investing_root:
        register_csv_table(spark, "investing_currencies", investing_root, INVESTING_SCHEMA,
                           header=True, replace=True, quote='"', escape='"')
        done.append("investing_currencies")
    return done
