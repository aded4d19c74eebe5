"""Exchange JSON: symbol lists and daily klines, parsed by Spark.

Both arrive as JSON text (a file per response, or a column of documents).
Parsing is ``from_json`` with a fixed schema, so unknown fields are ignored
and nothing passes through the driver.  A document that does not parse, or that
is not the expected reply (an error reply, a NULL), fails the query: dropping it
would silently lose every trade of its symbols or every day of its batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratesmith.session import cut_lineage

SYMBOL_FIELDS = ("symbol", "baseAsset", "quoteAsset")

EXCHANGE_INFO_SCHEMA = T.StructType([
    T.StructField("symbols", T.ArrayType(T.StructType(
        [T.StructField(f, T.StringType()) for f in SYMBOL_FIELDS]))),
])

KLINES_SCHEMA = T.ArrayType(T.ArrayType(T.StringType()))

# Kline field positions (fixed values of the exchange format).
KLINE_OPEN_TIME, KLINE_OPEN, KLINE_HIGH, KLINE_LOW, KLINE_CLOSE = 0, 1, 2, 3, 4


def symbols_from_documents(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Exchange-info documents ``{"symbols": [...]}`` -> ``symbol, baseAsset, quoteAsset``.

    One row per listed symbol; other fields are ignored.
    """
    parsed = F.from_json(F.col(text_col), EXCHANGE_INFO_SCHEMA, {"mode": "FAILFAST"})
    listed = docs.select(_required(parsed["symbols"], text_col, "symbol list").alias("symbols"))
    return listed.select(F.inline("symbols")).select(*SYMBOL_FIELDS)


def _required(value: Column, text_col: str, what: str) -> Column:
    """``value``, or an error naming the start of the document when it is NULL."""
    message = F.concat(F.lit(f"not a {what}: "), F.coalesce(F.substring(text_col, 1, 200), F.lit("NULL")))
    return F.when(value.isNull(), F.raise_error(message)).otherwise(value)


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Exchange-info JSON files (one document per file) -> symbols."""
    docs = spark.read.text(path, wholetext=True)
    return symbols_from_documents(docs)


def _kline_item(k: Column, i: int) -> Column:
    return F.get(k, F.lit(i))


def klines_daily(batches: DataFrame, text_col: str = "value") -> DataFrame:
    """Kline batches (JSON arrays of klines) -> daily rows.

    Output ``date, high, low, open, close, month``: the open time (epoch
    milliseconds) as a UTC date, prices as the exchange wrote them, and the
    ``yyyy-MM`` month the row is filed under.  Repeated klines are kept.
    """
    parsed = F.from_json(F.col(text_col), KLINES_SCHEMA, {"mode": "FAILFAST"})
    klines = batches.select(F.explode(_required(parsed, text_col, "kline batch")).alias("k"))
    open_ms = _kline_item(F.col("k"), KLINE_OPEN_TIME).cast("bigint")
    day = F.to_date(F.timestamp_millis(open_ms))
    return klines.select(
        day.alias("date"),
        _kline_item(F.col("k"), KLINE_HIGH).alias("high"),
        _kline_item(F.col("k"), KLINE_LOW).alias("low"),
        _kline_item(F.col("k"), KLINE_OPEN).alias("open"),
        _kline_item(F.col("k"), KLINE_CLOSE).alias("close"),
        F.date_format(day, "yyyy-MM").alias("month"),
    )


def read_klines(spark: SparkSession, path: str) -> DataFrame:
    """Kline response files (one JSON array per file) -> daily rows."""
    return klines_daily(spark.read.text(path, wholetext=True))


def write_klines_monthly(daily: DataFrame, root: str, mode: str = "append") -> None:
    """File daily rows as CSV lines ``date,high,low,open,close`` under ``month=yyyy-MM/``.

    The layout the OHLC reader expects (with its header line).  ``append``
    adds a batch's files to its months; ``overwrite`` replaces only the months
    present in the batch (dynamic partition overwrite), which makes re-running
    a batch of whole months idempotent.
    """
    writer = (daily.select(F.date_format("date", "yyyy-MM-dd").alias("Timestamp"),
                           F.col("high").alias("High"), F.col("low").alias("Low"),
                           F.col("open").alias("Open"), F.col("close").alias("Close"), "month")
              .write.mode(mode).option("header", "true").partitionBy("month"))
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.csv(root)


_MONTHLY_SCHEMA = "Timestamp string, High string, Low string, Open string, Close string, month string"
_PRICES = ("High", "Low", "Open", "Close")


def merge_klines_monthly(spark: SparkSession, daily: DataFrame, root: str) -> None:
    """Bring daily rows into the monthly files of ``root``: one line a day, the batch's taking the place of an older one.

    A keyed upsert over files: the months of the batch are read back, joined with it by day, and written
    as whole months (dynamic partition overwrite); other months are not touched.  Running a batch again, or
    batches that overlap, changes nothing but the days whose prices changed.  If a batch itself
    has a day more than once with different prices, the greatest (high, low, open, close) stays, so the
    result does not depend on the order of rows.  Rows without a date are an error.

    The merged months are computed into the checkpoint folder before any file is replaced, so the
    files being read are not the ones being written, and a failure before the last step leaves the root as it was.
    """
    day = F.date_format("date", "yyyy-MM-dd")
    batch = daily.select(F.coalesce(day, F.raise_error(F.lit("kline without an open time"))).alias("Timestamp"),
                         *[F.col(c.lower()).cast("string").alias(c) for c in _PRICES], F.date_format("date", "yyyy-MM").alias("month"))
    batch = cut_lineage(batch.withColumn("fresh", F.lit(1)), "kline-batch")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    rows = batch
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        # months are a small table (one row a month); joined, they prune the folders that are read
        months = F.broadcast(batch.select("month").distinct())
        old = spark.read.schema(_MONTHLY_SCHEMA).option("header", "true").csv(root)
        rows = old.join(months, "month", "left_semi").select(*[c for c in batch.columns if c != "fresh"], F.lit(0).alias("fresh")).unionByName(batch)
    order = F.struct("fresh", *[F.col(c).cast("double").alias(f"n{c}") for c in _PRICES], *_PRICES)
    merged = rows.groupBy("month", "Timestamp").agg(F.max(order).alias("row")).select("Timestamp", *[f"row.{c}" for c in _PRICES], "month")
    merged = cut_lineage(merged, "kline-months")
    (merged.hint("rebalance", "month").sortWithinPartitions("month", "Timestamp").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", "true").partitionBy("month").csv(root))
