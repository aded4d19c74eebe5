"""Results kept up to date by increments after a high-water mark.

A result table is a folder with one subfolder a run, ``after=<mark>``: the rows that the run added, where
the mark is the latest date the table held before it.  A run computes only what is newer than the
mark and overwrites its own subfolder (dynamic partition overwrite), so

* repeating a run that failed, or the last one (``redo_last``, for a day that was not complete
  when it was published), replaces its rows and repeats none,
* rows published by earlier runs are neither read as a whole nor written again,
* all subfolders together are the full run's result, row for row.

Rows without a date belong to no mark; they are few and kept in ``after=undated``, written anew by each run.

What must hold: a feed grows by rows dated after the mark.  Rows that arrive later for a published
date are not seen; ``redo_last`` or a full run (a new folder) picks them up.

*Closed rates* are derived date by date, so the increment is the closure of the newer rows.

*Exchange rates* fill the days between a pair's rows from the rows before, and pairs may lag behind the mark.
The increment of a pair starts after its own last published day: it is the fill of its newer rows with a
*tail* of the feed before them, the rows of the ``limit`` days up to that day, which hold all rows a
gap can be filled from (repeated rows included, which take up positions).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratesmith.operators import rates as R
from ratesmith.operators.closure import rate_closure
from ratesmith.operators.timeseries import FILL_LIMIT, fill_calendar
from ratesmith.session import cut_lineage, lineage_scope

MARK = "after"
FIRST, UNDATED = "0001-01-01", "undated"
RESULT_SCHEMA = "asset string, quote string, date date, rate double"


@dataclass(frozen=True)
class Run:
    """One run: the mark it started from (None at first), and how many rows it added."""

    mark: dt.date | None
    rows: int


def published(spark: SparkSession, root: str) -> DataFrame:
    """The table: ``asset, quote, date, rate`` and the run's ``after`` (an empty one if there is no folder)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{RESULT_SCHEMA}, {MARK} string")
    return spark.read.schema(f"{RESULT_SCHEMA}, {MARK} string").parquet(root)


def _same_pair(left: str, right: str) -> Column:
    return F.col(f"{left}.asset").eqNullSafe(F.col(f"{right}.asset")) & F.col(f"{left}.quote").eqNullSafe(F.col(f"{right}.quote"))


def closed_rates_after(feed: DataFrame, mark: dt.date | None, prior: DataFrame) -> DataFrame:
    """The closure of the feed's rows after the mark."""
    return rate_closure(feed if mark is None else feed.where(F.col("date") > F.lit(mark)))


def exchange_rates_after(rates: DataFrame, mark: dt.date | None, prior: DataFrame, limit: int = FILL_LIMIT) -> DataFrame:
    """What the filled, distinct rates (``asset, quote, date, rate``) have beyond ``prior``, published up to the mark."""
    if mark is None:
        return fill_calendar(rates, limit)
    new = rates.where(F.col("date") > F.lit(mark))
    pairs = new.select("asset", "quote").distinct()
    settled = prior.groupBy("asset", "quote").agg(F.max("date").alias("settled"))
    # pairs, not rows: one row for each pair that has newer rows
    settled = cut_lineage(settled.alias("s").join(pairs.alias("p"), _same_pair("s", "p"), "left_semi"), "settled-pairs")
    earliest = settled.agg(F.min("settled")).first()[0]
    if earliest is None:
        return fill_calendar(new, limit)
    # one date for all pairs, which reaches the scan; then each pair's own
    reach = rates.where((F.col("date") > F.lit(earliest - dt.timedelta(days=limit))) & (F.col("date") <= F.lit(mark)))
    tail = (reach.alias("r").join(settled.alias("s"), _same_pair("r", "s"))
            .where(F.col("r.date") > F.date_sub("s.settled", limit)).select("r.*"))
    filled = fill_calendar(tail.unionByName(new), limit)
    return (filled.alias("f").join(settled.alias("s"), _same_pair("f", "s"), "left")
            .where(F.col("s.settled").isNull() | (F.col("f.date") > F.col("s.settled"))).select("f.*"))


def _write(df: DataFrame, root: str, after: str) -> None:
    (df.selectExpr("CAST(asset AS STRING) AS asset", "CAST(quote AS STRING) AS quote", "CAST(date AS DATE) AS date",
                   "CAST(rate AS DOUBLE) AS rate").withColumn(MARK, F.lit(after))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MARK).parquet(root))


def _clear(spark: SparkSession, root: str, after: str) -> None:
    """Remove the rows of a run: an overwrite by no rows would leave them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{MARK}={after}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def update(spark: SparkSession, feed: DataFrame, root: str,
           increment: Callable[[DataFrame, dt.date | None, DataFrame], DataFrame], redo_last: bool = False) -> Run:
    """Bring the table under ``root`` up to date with ``feed`` (``asset, quote, date, rate``).

    ``increment(feed, mark, prior)`` gives the rows beyond the mark.  ``redo_last`` first forgets the last run.
    The marks (one a run) and one date pass through the driver.
    """
    with lineage_scope(spark):
        table = published(spark, root)
        marks = sorted(r[0] for r in table.select(MARK).where(F.col(MARK) != UNDATED).distinct().collect())
        if marks and redo_last:
            after = marks.pop()
            mark = None if after == FIRST else dt.date.fromisoformat(after)
        else:
            # the last run holds the latest date: only its folder is read
            mark = table.where(F.col(MARK) == marks[-1]).agg(F.max("date")).first()[0] if marks else None
            after = FIRST if mark is None else mark.isoformat()
        prior = table.where(F.col(MARK).isin(marks)).drop(MARK)
        dated = feed.where(F.col("date").isNotNull())
        rows = cut_lineage(increment(dated, mark, prior), "increment")
        count = rows.count()
        if count:
            _write(rows, root, after)
        elif redo_last:
            _clear(spark, root, after)
        undated = cut_lineage(increment(feed.where(F.col("date").isNull()), None, prior), "undated")
        if undated.isEmpty():
            _clear(spark, root, UNDATED)
        else:
            _write(undated, root, UNDATED)
        return Run(mark, count)


def update_closed_rates(spark: SparkSession, feed: DataFrame, root: str, redo_last: bool = False) -> Run:
    """:func:`assembly.closed_rates` of a growing feed, kept under ``root``."""
    return update(spark, feed, root, closed_rates_after, redo_last)


def update_exchange_rates(spark: SparkSession, crypto_rates: DataFrame, root: str, redo_last: bool = False) -> Run:
    """:func:`assembly.exchange_rates` of a growing feed, kept under ``root``."""
    return update(spark, R.close_rates(crypto_rates), root, exchange_rates_after, redo_last)
