"""Daily calendar operators: date spine and bounded forward fill.

Semantics, per pair over the days between its first and last date: lay out
the *dense sequence*, every day in order, an observed day as its rows
(ordered by rate, NULL first) and an absent day as one empty row.  An absent
day takes the first non-NULL rate among the ``limit`` rows before it (a chain
of one-row lags), else NULL.  Observed rows are never rewritten and filled
values never feed later days.  Rows with a NULL date are not in the sequence.
A pair with a NULL asset or quote never matches its own calendar (NULL keys
do not join), so all days of its span come out with a NULL rate.

This is the original's row-counted lag chain with a fixed order inside a day
(the original left it arbitrary).  With one row per (pair, day) the reach is
``limit`` days; repeated rows of a day take up positions like any row.

No dense sequence is built.  Rows are pre-aggregated to one per observed day
(the day's largest non-NULL rate, which is last in the day's order, and its
row count), and one ordered pass per pair computes, for each observed day,
the next observed day and the latest non-NULL donor, together with a running
count of the extra rows repeated days add, from which the distance in rows
between a donor and an absent day follows:
``(day - donor day) + extra(last observed day) - extra(donor day)``.  The
window's input for a pair is bounded by its calendar days, however many rows
a hot pair has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.functions.columns import repeat_rows
from ratesmith.operators.rates import ONCE, WEIGHT

FILL_LIMIT = 3


def _one_day() -> Column:
    return F.expr("INTERVAL 1 DAY")


def date_spine(rates_df: DataFrame) -> DataFrame:
    """Every day from each pair's first to last date: ``asset, quote, date``.

    The bounds are a partial aggregate; each pair's days are generated by one
    generator row, so the spine is produced without a join.  A pair whose
    dates are all NULL yields no day.
    """
    bounds = rates_df.groupBy("asset", "quote").agg(F.min("date").alias("lo"),
                                                    F.max("date").alias("hi"))
    return bounds.where(F.col("lo").isNotNull()).select(
        "asset", "quote", F.explode(F.sequence("lo", "hi", _one_day())).alias("date"))


def dense_calendar(rates_df: DataFrame) -> DataFrame:
    """Every day of each pair's span LEFT JOIN its observed rows.

    ``asset, quote, date, rate, observed``: a day with rows gives each of
    them (``observed`` true), a day without gives one row with a NULL rate.
    The observations are counted per (pair, day, rate) before the join and
    expanded after it, so a (pair, day) with many rows cannot overload the
    join (a left outer join's right side cannot be split for skew).
    """
    spine = date_spine(rates_df)
    counted = (rates_df.select("asset", "quote", "date", F.col("rate").cast("double"))
               .groupBy("asset", "quote", "date", "rate").agg(F.count(F.lit(1)).alias("n")))
    joined = spine.join(counted, ["asset", "quote", "date"], "left").select(
        "asset", "quote", "date", "rate", F.col("n").isNotNull().alias("observed"),
        F.coalesce(F.col("n"), F.lit(1)).alias("n"))
    return repeat_rows(joined, "n")


def observed_days(rates_df: DataFrame) -> DataFrame:
    """One row per observed (asset, quote, date): the day's donor (its largest
    non-NULL rate, the last in the day's order), its row count ``k`` and
    whether one of its rows has a NULL rate.

    A partial aggregate: repeated keys collapse before the shuffle.
    """
    return (rates_df.where(F.col("date").isNotNull())
            .groupBy("asset", "quote", "date")
            .agg(F.max("rate").alias("rate"), F.count(F.lit(1)).alias("k"),
                 F.bool_or(F.col("rate").isNull()).alias("has_null")))


def _pair_window(*order: str):
    w = Window.partitionBy("asset", "quote").orderBy(*order)
    return w, w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _with_neighbours(rows: DataFrame, w, running) -> DataFrame:
    """Add ``next_date`` (the next row's date) and ``last_donor`` (the latest
    non-NULL (date, rate, extra) up to this row); ``rows`` carries ``extra``."""
    donor = F.when(F.col("rate").isNotNull() & F.col("date").isNotNull(),
                   F.struct(F.col("date").alias("d"), F.col("rate").alias("r"),
                            F.col("extra").alias("x")))
    return rows.select("*", F.lead("date").over(w).alias("next_date"),
                       F.last(donor, ignorenulls=True).over(running).alias("last_donor"))


_ROWS = "array<struct<date:date,rate:double>>"


def _gap_rows(limit: int, own_day: Column) -> Column:
    """Array of ``(date, rate)`` rows the fill emits after this row (may be empty or NULL).

    Only a pair's last row of a day has a later ``next_date``.  A pair with a
    NULL asset or quote never matches its own calendar (NULL keys do not
    join), so every day of its span is emitted with a NULL rate: the gap days
    and, where ``own_day`` holds, the observed day itself.
    """
    keyed = F.col("asset").isNotNull() & F.col("quote").isNotNull()
    has_gap = F.datediff("next_date", "date") > 1
    days = F.sequence(F.date_add("date", 1), F.date_sub("next_date", 1), _one_day())
    none = F.array().cast(_ROWS)

    def fill(day: Column) -> Column:
        # rows between the donor and this day in the dense sequence
        reach = F.datediff(day, F.col("last_donor.d")) + F.col("extra") - F.col("last_donor.x")
        return F.struct(day.alias("date"),
                        F.when(reach <= F.lit(limit), F.col("last_donor.r")).cast("double").alias("rate"))

    def blank(day: Column) -> Column:
        return F.struct(day.alias("date"), F.lit(None).cast("double").alias("rate"))

    unkeyed = F.concat(
        F.when(own_day & F.col("date").isNotNull(), F.array(blank(F.col("date")))).otherwise(none),
        F.when(has_gap, F.transform(days, blank)).otherwise(none))
    return F.when(keyed, F.when(has_gap, F.transform(days, fill))).otherwise(unkeyed)


def _day_summary_gaps(days: DataFrame, limit: int, own_day: Column) -> DataFrame:
    """Fill rows from one row per (pair, day) with the day's donor ``rate``, row
    count ``k`` and NULL-rate flag ``has_null``.  Days with a NULL date take no part."""
    w, running = _pair_window("date")
    extra = F.sum(F.when(F.col("date").isNotNull(), F.col("k") - 1).otherwise(0)).over(running)
    days = _with_neighbours(days.withColumn("extra", extra), w, running)
    return days.select("asset", "quote", F.inline(_gap_rows(limit, own_day)))


def gap_fill(rates_df: DataFrame, limit: int = FILL_LIMIT) -> DataFrame:
    """Rows for the absent days of each pair: ``asset, quote, date, rate``.

    Observed days are reduced to one row each (``observed_days``); one ordered
    pass per pair gives each its next observed day, the latest donor and the
    running count of extra rows, and the absent days are generated in the same
    stage.  No spine join.
    """
    return _day_summary_gaps(observed_days(rates_df), limit, F.lit(True))


def fill_calendar(rates_df: DataFrame, limit: int = FILL_LIMIT) -> DataFrame:
    """Distinct input rows plus the filled absent days (union, then distinct).

    The distinct is a partial aggregate that also counts each distinct row's
    copies (a multiplicity column ``WEIGHT``, if present, counts as that many
    copies; rows flagged ``ONCE`` add one copy together).  Its result is the first half of the output, and, summed per
    (pair, day) into the day's donor and row count, the input of the fill's
    ordered pass.  Both halves read the same shuffle (exchange reuse), and the
    fill's window sees one row per pair-day, however many distinct rates a day
    has.  Filled rows fall on absent days only, so they cannot repeat an input
    row.
    """
    weighted = WEIGHT in rates_df.columns
    copies = F.sum(WEIGHT) if weighted else F.count(F.lit(1))
    if ONCE in rates_df.columns:
        copies = copies + F.max(ONCE)
    if rates_df.schema["rate"].dataType.typeName() != "double":
        rates_df = rates_df.withColumn("rate", F.col("rate").cast("double"))
    rows = rates_df.groupBy("asset", "quote", "date", "rate").agg(copies.alias("n"))
    days = rows.groupBy("asset", "quote", "date").agg(
        F.max("rate").alias("rate"), F.sum("n").alias("k"),
        F.bool_or(F.col("rate").isNull()).alias("has_null"))
    # ``n > 0`` always holds; it keeps the count in this half, so both halves
    # are the same aggregate and Spark computes (and shuffles) it once.
    distinct = rows.where(F.col("n") > 0).select("asset", "quote", "date", "rate")
    # a NULL-currency pair's day row (NULL rate) is already there if the day has one
    return distinct.unionByName(_day_summary_gaps(days, limit, ~F.col("has_null")))
