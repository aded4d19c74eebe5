import datetime as dt
import json
import os

from conftest import rows

from ratesmith.sources import exchange_json as XJ
from ratesmith.sources import files as SF
from ratesmith.sources import sinks as SK


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_currencylayer_partitioned_headerless(spark, scratch):
    put(f"{scratch}/cl/asset=USD/quote=UAH/part1.csv", "2024-01-01,x,y,40.5\n2024-01-02,x,y,\n")
    put(f"{scratch}/cl/asset=EUR/quote=USD/part1.csv", "2024-01-01,x,y,1.1\n")
    df = SF.read_currencylayer(spark, f"{scratch}/cl")
    assert rows(df, "asset", "quote", "date", "rate") == [
        ("EUR", "USD", dt.date(2024, 1, 1), 1.1), ("USD", "UAH", dt.date(2024, 1, 1), 40.5),
        ("USD", "UAH", dt.date(2024, 1, 2), None)]
    # pair filters prune folders
    plan = df.where("asset = 'EUR'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(asset" in plan


def test_ohlc_header_and_crypto_root_with_foreign_folder(spark, scratch):
    hdr = "Timestamp,High,Low,Open,Close\n"
    put(f"{scratch}/cur/exchange=binance/asset=BTC/quote=USDT/a.csv", hdr + "2024-01-01,2,1,1,1.5\n")
    put(f"{scratch}/cur/exchange=kraken/asset=BTC/quote=USDT/a.csv", hdr + "2024-01-01,2,1,1,1.6\n")
    put(f"{scratch}/cur/currencylayer/asset=USD/quote=UAH/a.csv", "2024-01-01,x,y,40.5\n")
    df = SF.read_crypto_rates(spark, f"{scratch}/cur")
    assert rows(df, "exchange", "asset", "quote", "Close") == [("binance", "BTC", "USDT", 1.5),
                                                               ("kraken", "BTC", "USDT", 1.6)]
    one = SF.read_ohlc(spark, f"{scratch}/cur/exchange=binance")
    assert rows(one, "Timestamp", "Close", "asset") == [(dt.date(2024, 1, 1), 1.5, "BTC")]


def test_investing_quoted(spark, scratch):
    put(f"{scratch}/inv/asset=USD/quote=UAH/a.csv",
        '"Date","Price","Open","High","Low","Vol.","Change %"\n'
        '"01/02/2024","40.1","40.0","40.5","39.9","1.2K","0.5%"\n'
        '"01/03/2024","40.2","40.1","40.6","40.0","","-0.1%"\n')
    df = SF.read_investing(spark, f"{scratch}/inv")
    assert rows(df, "Date", "Price", "Vol", "Change") == [("01/02/2024", 40.1, "1.2K", "0.5%"),
                                                          ("01/03/2024", 40.2, None, "-0.1%")]


def test_register_table_and_refresh_partitions(spark, scratch):
    put(f"{scratch}/t/asset=USD/quote=UAH/a.csv", "2024-01-01,x,y,40.5\n")
    name = "cl_" + os.path.basename(scratch).replace("-", "_")
    SF.register_csv_table(spark, name, f"{scratch}/t", SF.CURRENCYLAYER_SCHEMA)
    assert spark.table(name).count() == 1
    put(f"{scratch}/t/asset=EUR/quote=USD/a.csv", "2024-01-01,x,y,1.1\n")
    SF.refresh_partitions(spark, name)
    assert rows(spark.table(name), "asset") == [("EUR",), ("USD",)]
    spark.sql(f"DROP TABLE {name}")


def test_refresh_adds_only_what_is_new(spark, scratch):
    line = "2024-01-01,x,y,40.5\n"
    root, name = f"{scratch}/it's here", "cl_diff_" + os.path.basename(scratch).replace("-", "_")
    put(f"{root}/asset=USD/quote=UAH/a.csv", line)
    put(f"{root}/notes/readme.csv", "no partition\n")
    put(f"{root}/asset=USD/other=1/a.csv", line)
    put(f"{root}/asset=USD/loose.csv", line)
    try:
        SF.register_csv_table(spark, name, root, SF.CURRENCYLAYER_SCHEMA)
        assert spark.table(name).count() == 1
        assert SF.refresh_partitions(spark, name) == SF.PartitionChange((), ())  # no news, nothing sent
        put(f"{root}/asset=EUR/quote=USD/a.csv", line)
        put(f"{root}/asset=O%27X/quote=a%2Fb/a.csv", line)  # escaped folder names: O'X, a/b
        put(f"{root}/asset=USD/quote=UAH/b.csv", line)  # a file more in a known partition
        change = SF.refresh_partitions(spark, name)
        assert change.added == ((("asset", "EUR"), ("quote", "USD")), (("asset", "O'X"), ("quote", "a/b"))) and not change.dropped
        assert rows(spark.table(name), "asset", "quote") == [("EUR", "USD"), ("O'X", "a/b"), ("USD", "UAH"), ("USD", "UAH")]
        for i in range(7):
            put(f"{root}/asset=USD/quote=Q{i}/a.csv", line)
        SF.PARTITIONS_AT_ONCE, before = 3, SF.PARTITIONS_AT_ONCE
        try:
            assert len(SF.refresh_partitions(spark, name).added) == 7
        finally:
            SF.PARTITIONS_AT_ONCE = before
        os.rename(f"{root}/asset=EUR", f"{scratch}/gone")
        assert SF.refresh_partitions(spark, name) == SF.PartitionChange((), ())
        assert SF.refresh_partitions(spark, name, drop_missing=True).dropped == ((("asset", "EUR"), ("quote", "USD")),)
        assert spark.table(name).count() == 10
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_trade_exports_all_strings(spark, scratch):
    put(f"{scratch}/tr/a.csv", "Date(UTC),Pair,Side,Price,Executed,Amount,Fee\n"
                               "2024-01-01 00:00:00,BTCUSDT,BUY,1,2BTC,3USDT,0\n")
    put(f"{scratch}/tr/b.csv", "Date(UTC),Pair,Side,Price,Executed,Amount,Fee\n"
                               "2024-01-02 00:00:00,BTCUSDT,SELL,1,2BTC,3USDT,0\n")
    df = SF.read_trade_exports(spark, f"{scratch}/tr/*.csv")
    assert df.columns == list(SF.BINANCE_TRADE_COLUMNS)
    assert {f.dataType.typeName() for f in df.schema.fields} == {"string"}
    assert df.count() == 2
    fixed = SF.read_trade_exports(spark, f"{scratch}/tr", SF.BINANCE_TRADE_COLUMNS)
    assert fixed.count() == 2


def test_symbols_json_ignores_unknown_fields(spark, scratch):
    doc = {"timezone": "UTC", "rateLimits": [{"x": 1}],
           "symbols": [{"symbol": "BTCUSDT", "status": "TRADING", "baseAsset": "BTC", "quoteAsset": "USDT",
                        "filters": [{"a": 1}]},
                       {"symbol": "ETHBTC", "baseAsset": "ETH", "quoteAsset": "BTC", "extra": True}]}
    put(f"{scratch}/info/exchangeInfo.json", json.dumps(doc, indent=2))
    df = XJ.read_symbols(spark, f"{scratch}/info")
    assert rows(df) == [("BTCUSDT", "BTC", "USDT"), ("ETHBTC", "ETH", "BTC")]
    assert df.columns == ["symbol", "baseAsset", "quoteAsset"]


def _kline(day, o, h, lo, c):
    ms = int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp() * 1000)
    return [ms, f"{o:.8f}", f"{h:.8f}", f"{lo:.8f}", f"{c:.8f}", "100.00000000", ms + 86399999,
            "2000.00000000", 12, "50.00000000", "1000.00000000", "0"]


def _days(start, n, step=1):
    return [start + dt.timedelta(days=i * step) for i in range(n)]


def test_klines_daily_and_monthly_files(spark, scratch):
    days = (_days(dt.date(2020, 6, 24), 7) + _days(dt.date(2020, 7, 13), 9) + _days(dt.date(2020, 7, 27), 5)
            + _days(dt.date(2020, 8, 1), 28) + _days(dt.date(2022, 12, 29), 3) + _days(dt.date(2023, 1, 1), 9))
    klines = [_kline(d, 26.66 + i, 26.7 + i, 5.5 + i, 26.553 + i) for i, d in enumerate(days)]
    put(f"{scratch}/kl/resp.json", json.dumps(klines))
    daily = XJ.read_klines(spark, f"{scratch}/kl")
    assert daily.count() == 61
    first = daily.orderBy("date").first()
    # open time -> UTC date; order high, low, open, close
    assert (first.date, first.high, first.low, first.open, first.close) == (
        dt.date(2020, 6, 24), "26.70000000", "5.50000000", "26.66000000", "26.55300000")
    months = dict((r.month, r["count"]) for r in daily.groupBy("month").count().collect())
    assert months == {"2020-06": 7, "2020-07": 14, "2020-08": 28, "2022-12": 3, "2023-01": 9}
    XJ.write_klines_monthly(daily, f"{scratch}/monthly")
    folders = sorted(f for f in os.listdir(f"{scratch}/monthly") if f.startswith("month="))
    assert folders == ["month=2020-06", "month=2020-07", "month=2020-08", "month=2022-12", "month=2023-01"]
    back = spark.read.option("header", "true").schema(
        "Timestamp date, High double, Low double, Open double, Close double").csv(f"{scratch}/monthly/month=2020-06")
    assert back.count() == 7 and back.orderBy("Timestamp").first().Close == 26.553


def test_klines_keep_duplicates(spark):
    k = _kline(dt.date(2021, 1, 1), 1, 2, 0.5, 1.5)
    df = spark.createDataFrame([(json.dumps([k, k]),)], "value string")
    assert XJ.klines_daily(df).count() == 2


def test_write_files_partitioned(spark, scratch):
    df = spark.createDataFrame([("A", "B", dt.date(2024, 1, 1), 1.0), ("C", "D", dt.date(2024, 1, 1), 2.0)],
                               "asset string, quote string, date date, rate double")
    SK.write_files(df, f"{scratch}/out", partition_by=("asset", "quote"))
    assert os.path.isdir(f"{scratch}/out/asset=A/quote=B")
    assert spark.read.parquet(f"{scratch}/out").count() == 2


def test_jdbc_properties():
    props = SK.jdbc_properties("org.postgresql.Driver", "u", "p")
    assert props["truncate"] == "true" and props["batchsize"] == "10000"
    assert props["isolationLevel"] == "READ_COMMITTED"  # one transaction per task: retries are safe
    assert props["driver"] == "org.postgresql.Driver"
    assert SK.jdbc_properties("d", "u", "p", isolation_level="NONE")["isolationLevel"] == "NONE"


def test_register_rate_tables_crypto_root(spark, scratch):
    hdr = "Timestamp,High,Low,Open,Close\n"
    put(f"{scratch}/cur/exchange=binance/asset=BTC/quote=USDT/a.csv", hdr + "2024-01-01,2,1,1,1.5\n")
    put(f"{scratch}/cur/currencylayer/asset=USD/quote=UAH/a.csv", "2024-01-01,x,y,40.5\n")
    put(f"{scratch}/inv/asset=USD/quote=UAH/a.csv", '"Date","Price","Open","High","Low","Vol.","Change %"\n'
                                                    '"01/02/2024","40.1","40.0","40.5","39.9","1.2K","0.5%"\n')
    names = SF.register_rate_tables(spark, currencylayer_root=f"{scratch}/cur/currencylayer",
                                    ohlc_root=f"{scratch}/cur/exchange=binance",
                                    crypto_root=f"{scratch}/cur", investing_root=f"{scratch}/inv")
    try:
        assert rows(spark.table("crypto_rates"), "exchange", "asset", "quote", "Close") == [
            ("binance", "BTC", "USDT", 1.5)]
        assert rows(spark.table("currencylayer"), "asset", "rate") == [("USD", 40.5)]
        assert rows(spark.table("binance_currencies"), "asset", "Close") == [("BTC", 1.5)]
        assert rows(spark.table("investing_currencies"), "Date", "Price") == [("01/02/2024", 40.1)]
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_first_kline_of_the_original_test_gives_its_line(spark, scratch):
    # The first kline of the original unit test and the line it must produce.
    kline = [1592956800000, "26.66000000", "26.66000000", "5.50000000", "26.55300000", "33245.40000000",
             1593043199999, "854986.53980000", 128, "15721.80000000", "417686.26570000", "0"]
    expected = "2020-06-24,26.66000000,5.50000000,26.66000000,26.55300000"
    daily = XJ.klines_daily(spark.createDataFrame([(json.dumps([kline]),)], "value string"))
    XJ.write_klines_monthly(daily, f"{scratch}/m")
    lines = spark.read.text(f"{scratch}/m/month=2020-06").collect()
    assert [r.value for r in lines if not r.value.startswith("Timestamp")] == [expected]


def test_register_table_path_with_quote(spark, scratch):
    root = f"{scratch}/it's here"
    put(f"{root}/asset=USD/quote=UAH/a.csv", "2024-01-01,x,y,40.5\n")
    SF.register_csv_table(spark, "cl_quoted_path", root, SF.CURRENCYLAYER_SCHEMA, replace=True)
    try:
        assert spark.table("cl_quoted_path").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS cl_quoted_path")


def test_klines_overwrite_replaces_only_the_batch_months(spark, scratch):
    june = [_kline(dt.date(2020, 6, d), 1, 2, 0.5, 1.5) for d in (1, 2)]
    july = [_kline(dt.date(2020, 7, d), 1, 2, 0.5, 1.5) for d in (1, 2, 3)]
    batch = lambda ks: XJ.klines_daily(spark.createDataFrame([(json.dumps(ks),)], "value string"))
    XJ.write_klines_monthly(batch(june + july), f"{scratch}/k")
    XJ.write_klines_monthly(batch(july), f"{scratch}/k", mode="overwrite")  # re-run of July
    back = spark.read.option("header", "true").csv(f"{scratch}/k")
    assert dict((r.month, r["count"]) for r in back.groupBy("month").count().collect()) == {
        "2020-06": 2, "2020-07": 3}


def _monthly(spark, root):
    back = spark.read.option("header", "true").csv(root)
    return sorted((r.month, str(r.Timestamp), r.High, r.Close) for r in back.collect())


def _files(root):
    return {os.path.join(d, n): os.path.getmtime(os.path.join(d, n)) for d, _, names in os.walk(root) for n in names if n.endswith(".csv")}


def test_a_kline_batch_run_twice_changes_nothing(spark, scratch):
    batch = lambda ks: XJ.klines_daily(spark.createDataFrame([(json.dumps(ks),)], "value string"))
    root = f"{scratch}/k"
    june = [_kline(d, 1, 2, 0.5, 1.5) for d in _days(dt.date(2020, 6, 1), 30)]
    july = [_kline(d, 1, 2, 0.5, 1.5) for d in _days(dt.date(2020, 7, 1), 10)]
    XJ.merge_klines_monthly(spark, batch(june + july[:5]), root)
    once = _monthly(spark, root)
    assert len(once) == 35
    XJ.merge_klines_monthly(spark, batch(june + july[:5]), root)
    assert _monthly(spark, root) == once
    kept = {f: t for f, t in _files(root).items() if "2020-06" in f}
    # the next batch overlaps: a day got its final price, five days are new, June is not touched
    XJ.merge_klines_monthly(spark, batch([_kline(dt.date(2020, 7, 5), 1, 9, 0.5, 8.5)] + july[5:]), root)
    got = _monthly(spark, root)
    assert len(got) == 40 and ("2020-07", "2020-07-05", "9.00000000", "8.50000000") in got
    assert {f: t for f, t in _files(root).items() if "2020-06" in f} == kept
    # appending, as before, repeats the days
    XJ.write_klines_monthly(batch(july), root)
    assert len(_monthly(spark, root)) == 50
    XJ.merge_klines_monthly(spark, batch(july[:1]), root)  # and the next merge of the month mends it
    assert len(_monthly(spark, root)) == 40


def test_a_day_twice_in_one_batch_has_one_line(spark, scratch):
    day = dt.date(2021, 1, 1)
    for order in (1, -1):
        ks = [_kline(day, 1, 2, 0.5, 1.5), _kline(day, 1, 10, 0.5, 1.5), _kline(day, 1, 9, 0.5, 1.5)][::order]
        root = f"{scratch}/k{order}"
        XJ.merge_klines_monthly(spark, XJ.klines_daily(spark.createDataFrame([(json.dumps(ks),)], "value string")), root)
        assert _monthly(spark, root) == [("2021-01", "2021-01-01", "10.00000000", "1.50000000")]


def test_merged_files_read_as_the_exchange_wrote_them(spark, scratch):
    daily = XJ.klines_daily(spark.createDataFrame([(json.dumps([_kline(dt.date(2020, 6, 24), 26.66, 26.66, 5.5, 26.553)]),)], "value string"))
    XJ.merge_klines_monthly(spark, daily, f"{scratch}/m")
    lines = [r.value for r in spark.read.text(f"{scratch}/m/month=2020-06").collect()]
    assert lines == ["Timestamp,High,Low,Open,Close", "2020-06-24,26.66000000,5.50000000,26.66000000,26.55300000"]
