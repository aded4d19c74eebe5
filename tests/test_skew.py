"""Hot keys: results stay whole and exact, and the shuffles do not grow with the hot group.

Shuffle volume is read from the executed plan's metrics (records written by
each shuffle exchange).
"""

import datetime as dt

from pyspark.sql import functions as F

from ratesmith.operators import rates as R
from ratesmith.operators.closure import rate_closure
from ratesmith.operators.timeseries import gap_fill


def shuffle_records(df):
    """Run ``df`` and return the records written by all its shuffle exchanges."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # runs this very plan, so its metrics fill in
    plan = qe.executedPlan()
    total = 0
    stack = [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        if name == "Exchange":
            m = node.metrics()
            if m.contains("shuffleRecordsWritten"):
                total += m.get("shuffleRecordsWritten").get().value()
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return total


def hot_rates(spark, n):
    # n rows, every one quoted in USD on the same day: USD/USD identity is one hot key
    return (spark.range(n).select(F.concat(F.lit("C"), (F.col("id") % 1000).cast("string")).alias("asset"),
                                  F.lit("USD").alias("quote"), F.lit(dt.date(2024, 1, 1)).alias("date"),
                                  (F.col("id") % 97 + 1).cast("double").alias("rate")))


def test_closure_hot_currency(spark):
    df = hot_rates(spark, 200_000).repartition(8)
    out = rate_closure(df)
    got = {(r.asset, r.quote): r.rate for r in out.where("asset = 'USD' or quote = 'USD'").collect()
           if r.asset in ("USD", "C1") or r.quote == "C1"}
    assert got[("USD", "USD")] == 1.0
    assert got[("C1", "USD")] == min(float(i % 97 + 1) for i in range(1, 200_000, 1000))
    assert out.count() == 1000 * 3 + 1
    # the closure's own shuffle carries one row per key and map task, not one per member
    recs = shuffle_records(rate_closure(df))
    assert 0 < recs <= 200_000 + 8 * (1000 * 3 + 1)  # input repartition + partial aggregates


def test_reconcile_hot_key_is_exact_bag(spark):
    d = dt.date(2024, 1, 1)
    prim = spark.range(300).select(F.lit(d).alias("Timestamp"), F.lit(2.0).alias("Close"),
                                   F.lit("BTC").alias("asset"), F.lit("USDT").alias("quote"))
    sec = spark.range(200).select(F.lit("01/01/2024").alias("Date"), F.lit(3.0).alias("Price"),
                                  F.lit("BTC").alias("asset"), F.lit("USD").alias("quote"))
    out = R.reconcile_feeds(prim, sec)
    assert out.count() == 300 * 200
    assert out.distinct().collect()[0].rate == 2.0
    # both sides collapse to one row each before the join
    recs = shuffle_records(R.reconcile_feeds(prim.repartition(4), sec.repartition(4)))
    assert 500 < recs <= 500 + 4 * 2 + 2 * 2


def test_gap_fill_hot_pair_window_input_is_days(spark):
    # one pair with 50 rows on each of 10 days (every other day): the window sees 10 rows
    rows = spark.range(500).select(F.lit("A").alias("asset"), F.lit("B").alias("quote"),
                                   F.date_add(F.lit(dt.date(2024, 1, 1)), ((F.col("id") % 10) * 2).cast("int")
                                              ).alias("date"),
                                   (F.col("id") % 7).cast("double").alias("rate"))
    out = gap_fill(rows)
    assert out.count() == 9 and {r.rate for r in out.collect()} == {6.0}
    recs = shuffle_records(gap_fill(rows.repartition(4)))
    assert 500 < recs <= 500 + 4 * 10 + 10


def test_latest_rates_hot_pair(spark):
    df = hot_rates(spark, 50_000).withColumn("asset", F.lit("BTC"))
    out = R.latest_rates(df)
    assert out.count() == 50_000  # all rows are on the latest date: ties kept


def test_fill_calendar_window_sees_days_not_distinct_rates(spark):
    from ratesmith.operators.timeseries import fill_calendar

    # one pair, 5000 distinct rates over 10 observed days (every other day)
    rows = spark.range(5000).select(F.lit("A").alias("asset"), F.lit("B").alias("quote"),
                                    F.date_add(F.lit(dt.date(2024, 1, 1)), ((F.col("id") % 10) * 2).cast("int")
                                               ).alias("date"),
                                    F.col("id").cast("double").alias("rate")).repartition(4)
    out = fill_calendar(rows)
    assert out.count() == 5000 + 9
    # input spread (5000) + distinct (<= 5000) + day summaries (<= 4 tasks x 10 days) + window input (10 rows);
    # a window over the distinct rates would add another 5000
    recs = shuffle_records(fill_calendar(rows))
    assert 5000 < recs <= 5000 + 5000 + 4 * 10 + 10
