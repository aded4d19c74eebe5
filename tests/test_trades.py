import datetime as dt

from conftest import rows

from ratesmith.operators import trades as TR
from ratesmith.sources.files import BINANCE_TRADE_COLUMNS, EXMO_TRADE_COLUMNS

SYMBOLS = [("BTCUSDT", "BTC", "USDT"), ("1INCHBTC", "1INCH", "BTC")]


def binance(spark, data):
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in BINANCE_TRADE_COLUMNS))


def exmo(spark, data):
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in EXMO_TRADE_COLUMNS))


def syms(spark):
    return spark.createDataFrame(SYMBOLS, "symbol string, baseAsset string, quoteAsset string")


def test_binance_normalisation(spark):
    raw = binance(spark, [
        ("2024-01-05 10:11:12", "BTCUSDT", "BUY", "40,000.5USDT", "0.5BTC", "20,000.25USDT", "0.1"),
        ("2024-01-06 00:00:00", "BTCUSDT", "SELL", "41000", "1BTC", "41000USDT", "0"),
        ("2024-01-07 00:00:00", "1INCHBTC", "HOLD", "0.0001", "12.51INCH", "", "0"),
        ("2024-01-08 00:00:00", "NOPEBTC", "BUY", "1", "1", "1", "0"),
    ])
    t = {r.date: r for r in TR.normalise_trades(raw, TR.BINANCE, syms(spark)).collect()}
    assert set(t) == {dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7)}  # unknown symbol dropped
    buy = t[dt.date(2024, 1, 5)]
    assert (buy.side, buy.price, buy.executed) == ("BUY", 40000.5, 0.5)
    assert buy.amount == 20000.25 * 0.999
    assert (buy.total_asset_purchased, buy.total_asset_sold) == (0.5, 0.0)
    assert buy.total_quote_spent == -buy.amount and buy.total_quote_returned == 0.0
    assert (buy.balance_asset, buy.balance_quote) == (0.5, -buy.amount)
    assert (buy.baseAsset, buy.quoteAsset, buy.exchange) == ("BTC", "USDT", "binance")
    sell = t[dt.date(2024, 1, 6)]
    assert (sell.total_asset_sold, sell.total_quote_returned, sell.balance_asset) == (1.0, 41000 * 0.999, -1.0)
    hold = t[dt.date(2024, 1, 7)]
    # an unknown side is a SELL, and counts as sold
    assert (hold.side, hold.executed, hold.total_asset_sold, hold.amount) == ("SELL", 12.51, 12.51, None)
    assert list(TR.normalise_trades(raw, TR.BINANCE, syms(spark)).columns) == list(TR.TRADE_COLUMNS)


def test_exmo_normalisation(spark):
    raw = exmo(spark, [
        ("05.01.2024 10:11", "1", "buy", "BTC_USD", "2", "100", "200", "t", "0", "0.3"),
        ("06.01.2024 10:11", "2", "sell", "BTC_USD", "3", "100", "300", "t", "0", "0.3"),
        ("07.01.2024 10:11", "3", "cancel", "BTCUSD", "4", "abc", "400", "t", "0", "0.3"),
        ("bad", "4", "buy", "BTC_USD", "", "1", "1", "t", "0", "0.3"),
    ])
    out = TR.normalise_trades(raw, TR.EXMO).collect()
    by_exec = {r.executed: r for r in out}
    buy = by_exec[2.0]
    assert (buy.date, buy.side, buy.amount, buy.price) == (dt.date(2024, 1, 5), "BUY", 200 * 0.997, 100.0)
    assert buy.total_quote_spent == buy.amount  # positive on this exchange
    assert (buy.baseAsset, buy.quoteAsset) == ("BTC", "USD")
    sell = by_exec[3.0]
    assert (sell.total_asset_sold, sell.total_quote_returned, sell.balance_quote) == (3.0, 300 * 0.997, 300 * 0.997)
    other = by_exec[4.0]
    # unknown type: side SELL, but neither bought nor sold; pair without separator
    assert (other.side, other.total_asset_sold, other.total_quote_returned) == ("SELL", 0.0, 0.0)
    assert (other.balance_asset, other.price, other.baseAsset, other.quoteAsset) == (-4.0, None, "BTCUSD", None)
    bad = [r for r in out if r.executed is None][0]
    assert bad.date is None and bad.balance_asset is None


def _trades(spark):
    raw = binance(spark, [("2024-01-05 00:00:00", "BTCUSDT", "BUY", "100", "2BTC", "200USDT", "0"),
                          ("2024-01-06 00:00:00", "1INCHBTC", "SELL", "0.1", "10", "1BTC", "0")])
    return TR.normalise_trades(raw, TR.BINANCE, syms(spark))


def test_valuation_rates_and_missing_rate(spark):
    rates = spark.createDataFrame([("BTC", "USDT", dt.date(2024, 1, 5), 100.0),
                                   ("1INCH", "USDT", dt.date(2024, 1, 6), 0.5)],
                                  "asset string, quote string, date date, rate double")
    v = {r.baseAsset: r for r in TR.value_trades(_trades(spark), rates).collect()}
    btc, inch = v["BTC"], v["1INCH"]
    # quoted in USDT: the quote balance itself
    assert btc.usdt_balance_quote == btc.balance_quote and btc.usdt_rate == 100.0
    # no BTC/BTC rate: counts as 1
    assert btc.btc_rate is None and btc.btc_balance_quote == btc.balance_asset * 1
    assert btc.btc_total_quote_spent == btc.total_asset_purchased
    # 1INCH quoted in BTC: BTC values are the quote values; USDT through the rate
    assert inch.btc_balance_quote == inch.balance_quote
    assert inch.usdt_balance_quote == inch.balance_asset * 0.5
    assert inch.usdt_total_quote_returned == inch.total_asset_sold * 0.5
    assert TR.value_trades(_trades(spark), rates).columns == TR.valuation_columns()
    nulls = TR.value_trades(_trades(spark), rates, missing_rate=None).where("baseAsset = 'BTC'").collect()[0]
    assert nulls.btc_balance_quote is None


def test_duplicate_rates_repeat_trades(spark):
    rates = spark.createDataFrame([("BTC", "USDT", dt.date(2024, 1, 5), 100.0),
                                   ("BTC", "USDT", dt.date(2024, 1, 5), 101.0)],
                                  "asset string, quote string, date date, rate double")
    out = TR.value_trades(_trades(spark), rates)
    assert out.count() == 3
    assert rows(out.where("baseAsset = 'BTC'"), "usdt_rate") == [(100.0,), (101.0,)]


def test_union_keeps_all(spark):
    a = _trades(spark)
    b = TR.normalise_trades(exmo(spark, [("05.01.2024 10:11", "1", "buy", "BTC_USD", "2", "100", "200",
                                          "t", "0", "0.3")]), TR.EXMO)
    u = TR.union_trades(a, b)
    assert u.count() == 3 and rows(u, "exchange") == [("binance",), ("binance",), ("exmo",)]
