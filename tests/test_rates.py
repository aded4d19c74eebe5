import datetime as dt

from conftest import rows

from ratesmith.operators import rates as R

SCHEMA = "asset string, quote string, date date, rate double"
D0, D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
PRIMARY = "Timestamp date, High double, Low double, Open double, Close double, asset string, quote string"
SECONDARY = ("Date string, Price double, Open double, High double, Low double, Vol string, "
             "Change string, asset string, quote string")


def prim(spark, data):
    return spark.createDataFrame([(d, c, c, c, c, a, q) for a, q, d, c in data], PRIMARY)


def sec(spark, data):
    return spark.createDataFrame([(t, p, p, p, p, None, None, a, q) for a, q, t, p in data], SECONDARY)


def test_reconcile_regions_and_rate_choice(spark):
    p = prim(spark, [("BTC", "USD", D0, 10.0), ("BTC", "USD", D1, None), ("ETH", "USD", D0, 3.0)])
    s = sec(spark, [("BTC", "USD", "01/01/2024", 11.0), ("BTC", "USD", "01/02/2024", 12.0),
                    ("EUR", "USD", "01/03/2024", 1.1)])
    assert rows(R.reconcile_feeds(p, s)) == [
        ("BTC", "USD", D0, 10.0),   # both: primary close wins
        ("BTC", "USD", D1, 12.0),   # both, primary NULL: secondary price
        ("ETH", "USD", D0, 3.0),    # primary only
        ("EUR", "USD", D2, 1.1),    # secondary only
    ]


def test_reconcile_stablecoin_folding_multiplies(spark):
    # BTC/USDT and BTC/USD both become BTC/USD: one secondary row matches twice
    p = prim(spark, [("BTC", "USDT", D0, 10.0), ("BTC", "USD", D0, 10.5), ("USDT", "USD", D0, 1.0)])
    s = sec(spark, [("BTC", "USD", "01/01/2024", 11.0), ("BTC", "USD", "01/01/2024", 11.0)])
    got = rows(R.reconcile_feeds(p, s))
    assert got == sorted([("BTC", "USD", D0, 10.0)] * 2 + [("BTC", "USD", D0, 10.5)] * 2
                         + [("USD", "USD", D0, 1.0)], key=lambda r: tuple(str(x) for x in r))


def test_reconcile_null_and_bad_dates_never_match(spark):
    p = prim(spark, [("BTC", "USD", None, 10.0)])
    s = sec(spark, [("BTC", "USD", "13/45/2024", 11.0), ("BTC", "USD", "1/2/2024", 12.0)])
    got = rows(R.reconcile_feeds(p, s))
    assert got == [("BTC", "USD", None, 10.0), ("BTC", "USD", None, 11.0), ("BTC", "USD", None, 12.0)]


def test_filter_and_normalise(spark):
    df = spark.createDataFrame([("SOL", "USDT", D0, 1.0), ("USDT", "UAH", D0, 2.0), ("SOL", "EUR", D0, 3.0)],
                               SCHEMA)
    assert rows(R.normalise_pair(df), "asset", "quote") == [("SOL", "EUR"), ("SOL", "USD"), ("USD", "UAH")]
    assert rows(R.filter_currencies(df, ["UAH", "EUR"]), "rate") == [(2.0,), (3.0,)]


def test_cross_rates(spark):
    df = spark.createDataFrame([
        ("USD", "CZK", D0, 20.0), ("USD", "UAH", D0, 40.0), ("USD", "UAH", D1, 41.0),
        ("SOL", "USD", D0, 100.0), ("USD", "CZK", D1, 0.0)], SCHEMA)
    assert rows(R.cross_rate_common_base(df)) == [("CZK", "UAH", D0, 2.0), ("CZK", "UAH", D1, None)]
    assert rows(R.cross_rate_chain(df, [("SOL", "UAH", "USD")])) == [("SOL", "UAH", D0, 4000.0)]


def test_latest_rates_keeps_ties_drops_null_keys(spark):
    df = spark.createDataFrame([
        ("A", "B", D0, 1.0), ("A", "B", D1, 2.0), ("A", "B", D1, 3.0),
        (None, "B", D2, 9.0), ("C", "D", None, 5.0), ("C", "D", D0, 6.0)], SCHEMA)
    assert rows(R.latest_rates(df)) == [("A", "B", D1, 2.0), ("A", "B", D1, 3.0), ("C", "D", D0, 6.0)]


def test_inverse_and_identity(spark):
    df = spark.createDataFrame([("USD", "UAH", D0, 40.0), ("UAH", "USD", D0, 0.025),
                                ("BTC", "USD", D0, 0.0), ("USD", "UAH", D1, 41.0)], SCHEMA)
    assert rows(R.inverse_rates(df)) == [("UAH", "USD", D0, 1 / 40.0), ("UAH", "USD", D1, 1 / 41.0),
                                         ("USD", "BTC", D0, None)]
    assert rows(R.identity_rates(df)) == [("BTC", "BTC", D0, 1.0), ("UAH", "UAH", D0, 1.0),
                                          ("USD", "USD", D0, 1.0), ("USD", "USD", D1, 1.0)]


def test_distinct_keeps_different_rates(spark):
    df = spark.createDataFrame([("A", "B", D0, 1.0), ("A", "B", D0, 1.0), ("A", "B", D0, 2.0),
                                ("A", None, None, None), ("A", None, None, None)], SCHEMA)
    assert R.distinct_rates(df).count() == 3


def test_yearly_stats(spark):
    p = prim(spark, [("A", "B", dt.date(2023, 12, 31), 5.0), ("A", "B", D0, 7.0), ("A", "B", D1, 6.0)])
    assert rows(R.yearly_close_stats(p)) == [
        ("A", "B", 2023, dt.date(2023, 12, 31), dt.date(2023, 12, 31), 5.0, 5.0),
        ("A", "B", 2024, D0, D1, 6.0, 7.0)]
    s = sec(spark, [("A", "B", "01/01/2024", 3.0), ("A", "B", "bad", 4.0)])
    assert rows(R.yearly_price_stats(s)) == [("A", "B", 2024, D0, D0, 3.0, 3.0),
                                             ("A", "B", None, None, None, 4.0, 4.0)]
    assert R.yearly_close_stats(p).columns == ["asset", "quote", "year", "min_ts", "max_ts",
                                               "min_close", "max_close"]


def test_dated_prices(spark):
    s = sec(spark, [("A", "B", "02/29/2024", 3.0), ("A", "B", "2/3/2024", 4.0)])
    assert R.dated_prices(s).columns == ["asset", "quote", "year", "the_date", "Price", "Date", "High", "Low"]
    assert rows(R.dated_prices(s), "year", "the_date", "Date") == [
        (2024, dt.date(2024, 2, 29), "02/29/2024"), (None, None, "2/3/2024")]


def test_high_water_mark(spark):
    p = prim(spark, [("A", "B", D0, 1.0), ("A", "B", D2, 1.0), ("A", "C", dt.date(2030, 1, 1), 1.0)])
    assert R.high_water_mark(p, "A", "B").collect()[0].max_date == D2
    assert R.high_water_mark(p, "X", "Y").collect()[0].max_date == dt.date(2015, 1, 1)
    assert R.high_water_date(p, "A", "C") == dt.date(2030, 1, 1)


def test_close_rates_keeps_both_exchanges(spark):
    df = spark.createDataFrame(
        [("binance", "A", "B", D0, 1.0), ("kraken", "A", "B", D0, 1.5)],
        "exchange string, asset string, quote string, Timestamp date, Close double")
    assert rows(R.close_rates(df)) == [("A", "B", D0, 1.0), ("A", "B", D0, 1.5)]
