"""What must hold at scale: split hot keys, bounded broadcasts and arrays, plans that do not grow, nothing lost in silence."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ratesmith.functions.columns import repeat_rows
from ratesmith.operators import rates as R
from ratesmith.operators import trades as TR
from ratesmith.plans import assembly, jobs
from ratesmith.plans import fixtures as FX
from ratesmith.sources import exchange_json as XJ
from ratesmith.sources import files, sinks

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)
TRADES = ", ".join(f"{c} " + ("date" if c == "date" else "string" if c in ("exchange", "Pair", "side", "baseAsset", "quoteAsset") else "double")
                   for c in TR.TRADE_COLUMNS)


def some_trades(spark, n, hot):
    base = F.when(F.col("id") < hot * n, F.lit("BTC")).when(F.col("id") % 50 == 7, F.lit(None)).otherwise(
        F.concat(F.lit("A"), (F.col("id") % 500).cast("string")))
    values = {"exchange": F.lit("x"), "date": F.lit(DAY), "Pair": F.lit("P"), "side": F.lit("BUY"), "baseAsset": base, "quoteAsset": F.lit("EUR")}
    return spark.range(n).repartition(8).select(*[values.get(c, F.col("id").cast("double")).alias(c) for c in TR.TRADE_COLUMNS])


def some_rates(spark):
    data = [(f"A{i}", q, DAY, float(i + k)) for i in range(500) for k, q in enumerate(("BTC", "USDT"))]
    data += [("BTC", "USDT", DAY, 5.0), ("BTC", "USDT", DAY, 6.0), ("BTC", "BTC", DAY, 1.0), (None, "BTC", DAY, 9.0), ("A1", "USDT", None, 9.0)]
    return spark.createDataFrame(data, "asset string, quote string, date date, rate double")


def test_hot_key_of_the_valuation_is_split(spark):
    trades, rates = some_trades(spark, 60_000, 0.9), some_rates(spark)
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = TR.value_trades(trades, rates, broadcast_rows=0)
        df._jdf.queryExecution().toRdd().count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") and "skew=true" in plan.split("== Initial Plan ==")[0]
        split = sorted(map(str, df.collect()))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    broadcast = TR.value_trades(trades, rates)
    assert "BroadcastHashJoin" in broadcast._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, broadcast.collect())) == split
    assert len(split) == 60_000 + 54_000  # two rates of BTC/USDT repeat its trades


def test_the_salt_of_unmatched_trades_is_their_content(spark):
    """A stage that runs again over its input in another order sends every row to the partition it was sent to."""
    trades = some_trades(spark, 4000, 0.1).withColumn("baseAsset", F.when(F.col("price") % 3 == 0, F.col("baseAsset")))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        places = []
        for order in (trades, trades.orderBy(F.desc("price")), trades.repartition(3, "executed")):
            df = TR.value_trades(order, some_rates(spark), broadcast_rows=0)
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert "monotonically_increasing_id" not in plan and "xxhash64" in plan
            key = F.coalesce(F.when(F.col("baseAsset").isNull(), F.concat(F.lit("\0"), F.xxhash64(*order.columns).cast("string"))), F.lit("keyed"))
            places.append(sorted((r.price, r.key) for r in order.select("price", key.alias("key")).collect()))
            values = rows(df)
            assert values == rows(TR.value_trades(trades, some_rates(spark)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert places[0] == places[1] == places[2]
    assert len({k for _, k in places[0]}) > 2000  # and spread


def test_lookup_has_one_row_per_pair_of_rates(spark):
    got = rows(TR.valuation_lookup(some_rates(spark), ("BTC", "USDT")).where("_asset = 'BTC'"))
    assert got == [(DAY, "BTC", 1.0, 5.0), (DAY, "BTC", 1.0, 6.0)]


def test_row_bound_matches_the_built_size(spark):
    n = 20_000
    look = spark.range(n).select(F.lit(DAY).alias("_date"), F.concat(F.lit("A"), F.col("id").cast("string")).alias("_asset"),
                                 F.rand(1).alias("btc_rate"), F.rand(2).alias("usdt_rate"))
    df = some_trades(spark, 10, 1.0).join(F.broadcast(look), (F.col("date") == F.col("_date")) & (F.col("baseAsset") == F.col("_asset")), "left")
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan()
    stack, size = [plan], 0
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
        else:
            if name == "BroadcastExchange":
                size = max(size, node.metrics().get("dataSize").get().value())
            stack += [node.children().apply(i) for i in range(node.children().size())]
    assert 0.3 * TR.LOOKUP_ROW_BYTES < size / n < 2 * TR.LOOKUP_ROW_BYTES


def test_jdbc_result_is_computed_with_all_its_partitions(spark):
    df = spark.range(1000).repartition(40).select(F.col("id"), F.spark_partition_id().alias("p"))
    table = sinks.computed_first(df)
    assert rows(table.select("id")) == rows(df.select("id"))
    assert table.select("p").distinct().count() == 40  # the rows were computed in 40 tasks, whatever copies them


def test_only_the_copy_into_the_database_is_held_to_the_connections(monkeypatch, spark):
    seen = {}
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", lambda self, url, table, mode=None, properties=None: seen.update(df=self._df, props=properties))
    df = spark.range(1000).repartition(40, "id").groupBy("id").count()
    sinks.write_jdbc(df, "jdbc:none", "t", {})
    plan = seen["df"]._jdf.queryExecution().executedPlan().toString()
    assert seen["props"]["numPartitions"] == "32" and "Exchange" not in plan and "FileScan" in plan


@pytest.mark.parametrize("text", ['{"symbols": [{"symbol": "AB", "baseAsset": "A", "quo', '{"code": -1, "msg": "too many"}', None])
def test_broken_symbol_documents_fail(spark, text):
    good = json.dumps({"symbols": [{"symbol": "AB", "baseAsset": "A", "quoteAsset": "B"}]})
    docs = spark.createDataFrame([(good,), (text,)], "value string")
    with pytest.raises(Exception, match="symbol list|MALFORMED|malformed|Malformed"):
        XJ.symbols_from_documents(docs).collect()


@pytest.mark.parametrize("text", ['[[1,"1","2","3","4","5",6],[2,"1","2"', '{"code": -1, "msg": "too many"}', None])
def test_broken_kline_batches_fail(spark, text):
    docs = spark.createDataFrame([('[[1,"1","2","3","4","5",6]]',), (text,)], "value string")
    with pytest.raises(Exception, match="kline batch|MALFORMED|malformed|Malformed"):
        XJ.klines_daily(docs).collect()


def scans_and_joins(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation ["), plan.count("Join ")


def test_market_plan_does_not_grow_with_the_derivations(spark, scratch):
    FX.ohlc(spark, SF).write.parquet(f"{scratch}/o")
    FX.investing(spark, SF).write.parquet(f"{scratch}/i")
    feeds = [spark.read.parquet(f"{scratch}/{x}") for x in "oi"]
    chains = [(a, q, "USD") for a in ("SOL", "BTC", "EUR", "X1", "X2", "X3") for q in ("UAH", "CZK")]
    two, twelve = (scans_and_joins(assembly.market_rates(*feeds, chains=c)) for c in (chains[:2], chains))
    assert two == twelve and two[0] <= 18  # 9 for the derivations, read by both halves of the fill (one shuffle)


def test_rows_repeat_in_chunks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25), ("c", 7), ("d", 10)], "k string, n long")
    got = {r.k: r["count"] for r in repeat_rows(df, "n", chunk=10).groupBy("k").count().collect()}
    assert got == {"a": 1, "b": 25, "c": 7, "d": 10}
    big = spark.createDataFrame([("a", 1_000_000)], "k string, n long")
    assert R.expand_counts(big, "n").count() == 1_000_000


def test_a_changed_root_takes_effect(spark, scratch):
    for name, close in (("one", "1.0"), ("two", "2.0")):
        (spark.createDataFrame([(DAY, 1.0, 1.0, 1.0, float(close), "BTC", "USD")],
                               "Timestamp date, High double, Low double, Open double, Close double, asset string, quote string")
         .write.partitionBy("asset", "quote").option("header", "true").csv(f"{scratch}/{name}"))
        files.register_rate_tables(spark, ohlc_root=f"{scratch}/{name}")
        assert [r.Close for r in spark.table("binance_currencies").select(F.col("Close").cast("double")).collect()] == [float(close)]


def test_jobs_name_missing_arguments(capsys):
    with pytest.raises(SystemExit):
        jobs.main(["exchange-trades", "--crypto", "x", "--out", "y"])
    assert "--binance --exmo --symbols" in capsys.readouterr().err
