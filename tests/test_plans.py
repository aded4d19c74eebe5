"""Plan shape of the operators whose cost matters at scale."""

import datetime as dt
import re

from ratesmith.operators import rates as R
from ratesmith.plans import fixtures as FX
from ratesmith.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trade_valuation_never_shuffles_trades(spark):
    plan = plan_of(QUERIES["trade_valuation"](spark, SF))
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 2          # symbols, and one lookup of all currencies
    assert "Exchange hashpartitioning" not in plan


def test_broadcast_only_under_the_size_bound(spark):
    from ratesmith.functions.joins import broadcast_if_small, estimated_bytes

    small = spark.sql("SELECT * FROM VALUES ('AB', 'A', 'B') AS s(symbol, baseAsset, quoteAsset)")
    assert 0 < estimated_bytes(small) < 1024
    hinted = broadcast_if_small(small)
    assert hinted is not small and "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    # over the bound (or without an estimate) the side is returned untouched, for the planner to decide
    assert broadcast_if_small(small, max_bytes=1) is small


def test_reconcile_aggregates_each_side_before_the_join(spark):
    plan = plan_of(R.reconcile_feeds(FX.ohlc(spark, SF), FX.investing(spark, SF)))
    join_at = plan.index("SortMergeJoin")
    below = plan[join_at:]
    assert below.count("functions=[count(1)]") == 2 and "FullOuter" in plan


def test_latest_rates_is_aggregate_plus_semi_join(spark):
    plan = plan_of(R.latest_rates(FX.fx(spark, SF)))
    assert "LeftSemi" in plan and "max(date" in plan and "Window" not in plan


def test_cross_rate_filters_reach_the_scan(spark, scratch):
    df = spark.createDataFrame([("USD", "CZK", dt.date(2024, 1, 1), 20.0)],
                               "asset string, quote string, date date, rate double")
    df.write.partitionBy("asset", "quote").parquet(f"{scratch}/r")
    plan = plan_of(R.cross_rate_common_base(spark.read.parquet(f"{scratch}/r")))
    pruned = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert pruned and all("asset" in p and "quote" in p for p in pruned)


def test_no_python_anywhere(spark):
    for name in ("rate_closure", "gap_fill", "trades_union", "klines_daily", "symbols_from_json"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_market_currency_filter_prunes_feed_folders(spark, scratch):
    from ratesmith.sources import files

    o = FX.ohlc(spark, SF)
    o.write.partitionBy("asset", "quote").option("header", "true").csv(f"{scratch}/ohlc")
    i = FX.investing(spark, SF)
    i.write.partitionBy("asset", "quote").option("header", "true").csv(f"{scratch}/inv")
    df = R.reconcile_feeds(files.read_ohlc(spark, f"{scratch}/ohlc"),
                           files.read_investing(spark, f"{scratch}/inv"), currencies=["UAH"])
    pruned = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_of(df))
    assert len(pruned) == 2 and all("UAH" in p for p in pruned)


def test_market_rates_never_expand_copies(spark):
    from ratesmith.plans import assembly

    df = assembly.market_rates(FX.ohlc(spark, SF), FX.investing(spark, SF), materialize=False)
    plan = plan_of(df)
    assert "sequence(1," not in plan.replace(" ", "")   # copies stay weights; only calendar days are generated
    assert "FullOuter" in plan


def test_fill_calendar_reads_the_distinct_once(spark, scratch):
    from ratesmith.operators.timeseries import fill_calendar

    FX.fx(spark, SF).write.parquet(f"{scratch}/fx")
    df = fill_calendar(spark.read.parquet(f"{scratch}/fx"))
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    final = qe.executedPlan().executedPlan().toString()
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 1
