"""Jobs end to end: source files written from the derived inputs, read back, published as files."""

import json

from pyspark.sql import functions as F

from conftest import rows

from ratesmith.operators import rates as R
from ratesmith.operators import trades as TR
from ratesmith.operators.closure import rate_closure
from ratesmith.plans import assembly, jobs
from ratesmith.plans import fixtures as FX
from ratesmith.plans.queries import FIXTURE_VALUATION_CURRENCIES

SF = "/root/testdata/sf0.001"


def test_closed_rates_job(spark, scratch):
    fx = FX.fx(spark, SF)
    (fx.select("date", F.col("asset").alias("ast"), F.col("quote").alias("qout"), "rate", "asset", "quote")
     .write.partitionBy("asset", "quote").csv(f"{scratch}/currencylayer"))
    jobs.publish_closed_rates(spark, f"{scratch}/currencylayer", jobs.file_sink(f"{scratch}/out"))
    got = spark.read.parquet(f"{scratch}/out/{jobs.CLOSED_RATES_TABLE}")
    assert got.columns == ["date", "asset", "quote", "rate"]
    assert rows(got) == rows(rate_closure(fx))


def test_exchange_rates_job(spark, scratch):
    o = FX.ohlc(spark, SF)
    (o.withColumn("exchange", F.lit("binance"))
     .write.partitionBy("exchange", "asset", "quote").option("header", "true").csv(f"{scratch}/currency"))
    # a headerless feed of another layout in the same root must not leak in
    (FX.fx(spark, SF).limit(3).write.partitionBy("asset", "quote").csv(f"{scratch}/currency/currencylayer"))
    jobs.publish_exchange_rates(spark, f"{scratch}/currency", jobs.file_sink(f"{scratch}/out"))
    got = spark.read.parquet(f"{scratch}/out/{jobs.EXCHANGE_RATES_TABLE}")
    assert rows(got) == rows(assembly.exchange_rates(o))
    latest = spark.read.parquet(f"{scratch}/out/{jobs.LATEST_RATES_TABLE}")
    assert latest.count() == 22 and latest.select("asset", "quote").distinct().count() == 22


def test_trade_history_job(spark, scratch):
    ta, tb = FX.trades_a(spark, SF), FX.trades_b(spark, SF)
    ta.drop("l_orderkey", "l_linenumber").write.option("header", "true").csv(f"{scratch}/trades/binance")
    tb.drop("o_orderkey").write.option("header", "true").csv(f"{scratch}/trades/exmo")
    symbols = [{"symbol": b + q, "baseAsset": b, "quoteAsset": q, "status": "TRADING"}
               for b in FX.TRADE_BASE for q in FX.TRADE_QUOTE if b != q]
    import os
    os.makedirs(f"{scratch}/info")
    with open(f"{scratch}/info/exchangeInfo.json", "w") as f:
        json.dump({"timezone": "UTC", "symbols": symbols}, f)
    rates = assembly.exchange_rates(FX.ohlc(spark, SF))
    rates.write.parquet(f"{scratch}/rates")

    def sink(df, table):
        jobs.file_sink(f"{scratch}/out")(df, table)

    # the job values in the reference currencies; check against the same composition in memory
    jobs.publish_trade_history(spark, f"{scratch}/trades/binance/*.csv", f"{scratch}/trades/exmo/*.csv",
                               f"{scratch}/info", spark.read.parquet(f"{scratch}/rates"), sink)
    got = spark.read.parquet(f"{scratch}/out/{jobs.TRADE_HISTORY_TABLE}")
    assert got.columns == TR.valuation_columns()
    want = assembly.trade_history(ta, spark.createDataFrame(
        [(s["symbol"], s["baseAsset"], s["quoteAsset"]) for s in symbols],
        "symbol string, baseAsset string, quoteAsset string"), tb, rates)
    assert got.count() == want.count() == 1500 + 6000
    assert rows(got) == rows(want)
    # the fixture currencies also work end to end
    assert assembly.trade_history(ta, spark.read.parquet(f"{scratch}/rates").limit(0).select(
        F.lit("x").alias("symbol"), F.lit("x").alias("baseAsset"), F.lit("x").alias("quoteAsset")),
        tb, rates, FIXTURE_VALUATION_CURRENCIES).count() == tb.count()  # no symbol known: only the other exchange's trades


def test_lineage_scope_removes_its_tables(spark):
    import os

    from ratesmith.session import cut_lineage, lineage_scope

    with lineage_scope(spark) as folder:
        df = cut_lineage(spark.range(10), "probe")
        assert df.count() == 10
        local = folder.removeprefix("file:")
        assert os.path.isdir(local) and os.listdir(local)
    assert not os.path.exists(local)


def test_command_line_closed_rates(spark, scratch):
    fx = FX.fx(spark, SF)
    (fx.select("date", F.col("asset").alias("ast"), F.col("quote").alias("qout"), "rate", "asset", "quote")
     .write.partitionBy("asset", "quote").csv(f"{scratch}/cl"))
    jobs.main(["closed-rates", "--currencylayer", f"{scratch}/cl", "--out", f"{scratch}/out"])
    assert spark.read.parquet(f"{scratch}/out/{jobs.CLOSED_RATES_TABLE}").count() == 777


def test_rate_catalog_over_registered_tables(spark, scratch):
    from ratesmith.plans.catalog import RateCatalog

    o = FX.ohlc(spark, SF)
    (o.withColumn("exchange", F.lit("binance"))
     .write.partitionBy("exchange", "asset", "quote").option("header", "true").csv(f"{scratch}/currency"))
    fx = FX.fx(spark, SF)
    (fx.select("date", F.col("asset").alias("ast"), F.col("quote").alias("qout"), "rate", "asset", "quote")
     .write.partitionBy("asset", "quote").csv(f"{scratch}/currency/currencylayer"))
    svc = RateCatalog(spark)
    names = svc.register(currencylayer_root=f"{scratch}/currency/currencylayer",
                         ohlc_root=f"{scratch}/currency/exchange=binance", crypto_root=f"{scratch}/currency")
    try:
        assert svc.closed_rates().count() == 777
        assert rows(svc.exchange_rates()) == rows(assembly.exchange_rates(o))
        assert svc.latest_rates(svc.exchange_rates()).count() == 22
        assert rows(svc.yearly_close_stats()) == rows(R.yearly_close_stats(o))
        assert svc.high_water_mark("BTC", "USD").count() == 1
        svc.refresh()
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_symbols_from_large_json_are_broadcast_after_the_cut(spark, scratch):
    import os

    from ratesmith.functions.joins import DEFAULT_BROADCAST_BYTES, estimated_bytes
    from ratesmith.session import cut_lineage
    from ratesmith.sources import exchange_json as XJ

    # a big exchange-info document: few symbols, many bytes of other fields
    filler = "x" * 5000
    syms = [{"symbol": f"S{i}USDT", "baseAsset": f"S{i}", "quoteAsset": "USDT", "filters": [filler] * 2}
            for i in range(1000)]
    os.makedirs(f"{scratch}/info")
    with open(f"{scratch}/info/exchangeInfo.json", "w") as f:
        json.dump({"symbols": syms}, f)
    raw = XJ.read_symbols(spark, f"{scratch}/info")
    assert estimated_bytes(raw) > DEFAULT_BROADCAST_BYTES      # the file size drives the estimate
    cut = cut_lineage(raw, "symbols")
    assert estimated_bytes(cut) < DEFAULT_BROADCAST_BYTES      # the real table is small
    assert cut.count() == 1000


def test_market_rates_job_from_csv_feeds(spark, scratch):
    o, i = FX.ohlc(spark, SF), FX.investing(spark, SF)
    o.write.partitionBy("asset", "quote").option("header", "true").csv(f"{scratch}/ohlc")
    (i.write.partitionBy("asset", "quote").option("header", "true").option("quoteAll", "true")
     .csv(f"{scratch}/investing"))
    jobs.publish_market_rates(spark, f"{scratch}/ohlc", f"{scratch}/investing", jobs.file_sink(f"{scratch}/out"))
    got = spark.read.parquet(f"{scratch}/out/{jobs.CLOSED_RATES_TABLE}")
    want = assembly.market_rates(o, i, materialize=False)
    assert got.count() == want.count() > 0
    assert rows(got, "asset", "quote", "date", "rate") == rows(want, "asset", "quote", "date", "rate")


def test_rate_catalog_market_rates_and_reconciliation(spark, scratch):
    from ratesmith.plans.catalog import RateCatalog

    o, i = FX.ohlc(spark, SF), FX.investing(spark, SF)
    o.write.partitionBy("asset", "quote").option("header", "true").csv(f"{scratch}/ohlc")
    i.write.partitionBy("asset", "quote").option("header", "true").csv(f"{scratch}/inv")
    svc = RateCatalog(spark)
    names = svc.register(ohlc_root=f"{scratch}/ohlc", investing_root=f"{scratch}/inv")
    try:
        assert rows(svc.reconciled()) == rows(R.reconcile_feeds(o, i))
        assert rows(svc.market_rates()) == rows(assembly.market_rates(o, i, materialize=False))
        assert rows(svc.yearly_price_stats()) == rows(R.yearly_price_stats(i))
        assert svc.dated_prices().count() == i.count()
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_command_line_exchange_rates(spark, scratch):
    o = FX.ohlc(spark, SF)
    (o.withColumn("exchange", F.lit("kraken"))
     .write.partitionBy("exchange", "asset", "quote").option("header", "true").csv(f"{scratch}/currency"))
    jobs.main(["exchange-rates", "--crypto", f"{scratch}/currency", "--out", f"{scratch}/out"])
    assert spark.read.parquet(f"{scratch}/out/{jobs.EXCHANGE_RATES_TABLE}").count() == \
        assembly.exchange_rates(o).count()
    assert spark.read.parquet(f"{scratch}/out/{jobs.LATEST_RATES_TABLE}").count() == 22


def test_command_line_market_rates_with_currencies(spark, scratch):
    o, i = FX.ohlc(spark, SF), FX.investing(spark, SF)
    o.write.partitionBy("asset", "quote").option("header", "true").csv(f"{scratch}/ohlc")
    i.write.partitionBy("asset", "quote").option("header", "true").csv(f"{scratch}/inv")
    jobs.main(["market-rates", "--ohlc", f"{scratch}/ohlc", "--investing", f"{scratch}/inv",
               "--currencies", "UAH,CZK", "--out", f"{scratch}/out"])
    got = spark.read.parquet(f"{scratch}/out/{jobs.CLOSED_RATES_TABLE}")
    want = assembly.market_rates(o, i, ("UAH", "CZK"), materialize=False)
    assert rows(got, "asset", "quote", "date", "rate") == rows(want, "asset", "quote", "date", "rate")
