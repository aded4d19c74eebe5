"""Rejected lines of the rate files, and exports aligned by their own headers."""

import datetime as dt
import os
from collections import Counter

import pytest

from conftest import rows

from ratesmith.operators import trades as TR
from ratesmith.plans import jobs
from ratesmith.sources import checked as C
from ratesmith.sources import files as SF

DAY = dt.date(2024, 1, 1)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def lines_of(root):
    return sum(bool(line.strip()) for d, _, names in os.walk(root) for n in names if n.endswith(".csv")
               for line in open(os.path.join(d, n)).read().split("\n"))


GOOD = ["2024-01-01,x,y,40.5", "2024-01-02,x,y,", "2024-01-03,x,y,-1e-3"]
BAD = ["2024-13-01,x,y,1.0", "2024-01-04,x,y", "2024-01-05,x,y,1.0,extra", "2024-01-06,x,y,forty", "not a line at all", ",,"]


def test_headerless_lines_are_good_or_rejected(spark, scratch):
    put(f"{scratch}/cl/asset=USD/quote=UAH/a.csv", "\n".join([GOOD[0], BAD[0], GOOD[1], BAD[1], "", BAD[2]]) + "\n")
    put(f"{scratch}/cl/asset=EUR/quote=USD/a.csv", "\n".join([GOOD[2], BAD[3], BAD[4], BAD[5]]))
    got = C.read_checked(spark, "currencylayer", f"{scratch}/cl")
    assert got.good.columns == SF.read_currencylayer(spark, f"{scratch}/cl").columns
    assert rows(got.good, "asset", "date", "rate") == [("EUR", dt.date(2024, 1, 3), -0.001), ("USD", DAY, 40.5), ("USD", dt.date(2024, 1, 2), None)]
    assert sorted(r.line for r in got.rejects.collect()) == sorted(BAD)
    assert got.good.count() + got.rejects.count() == lines_of(f"{scratch}/cl")
    unread = {r.line: (r.unread, r.asset) for r in got.rejects.collect()}
    assert unread[BAD[0]] == (["date"], "USD") and unread[BAD[3]] == (["rate"], "EUR")
    assert sorted((os.path.basename(os.path.dirname(os.path.dirname(r.file))), r.rejected) for r in got.counts().collect()) == [
        ("asset=EUR", 3), ("asset=USD", 3)]


def test_the_verdict_does_not_depend_on_the_columns_asked_for(spark, scratch):
    put(f"{scratch}/cl/asset=USD/quote=UAH/a.csv", "\n".join(GOOD + BAD))
    got = C.read_checked(spark, "currencylayer", f"{scratch}/cl")
    assert got.good.select("ast").count() == len(GOOD) and got.good.select("asset").count() == len(GOOD)
    assert got.good.where("rate > 0").count() == 1 and got.rejects.select("line").count() == len(BAD)
    plan = got.good.where("asset = 'EUR'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(asset" in plan


def test_headers_are_known_by_name_not_by_place(spark, scratch):
    hdr = "Timestamp,High,Low,Open,Close\n"
    put(f"{scratch}/cur/exchange=a/asset=BTC/quote=USDT/a.csv", hdr + "2024-01-01,2,1,1,1.5\n2024-01-02,2,1,oops,1.5\n")
    put(f"{scratch}/cur/exchange=b/asset=BTC/quote=USDT/a.csv", "2024-01-01,2,1,1,1.6\n2024-01-02,2,1,1,1.7\n")  # no header
    put(f"{scratch}/cur/exchange=b/asset=BTC/quote=USDT/b.csv", "timestamp, high, low, open, close\n")
    put(f"{scratch}/cur/currencylayer/asset=USD/quote=UAH/a.csv", "2024-01-01,x,y,40.5\n")
    got = C.read_checked(spark, "crypto", f"{scratch}/cur")
    assert rows(got.good, "exchange", "Timestamp", "Close") == [
        ("a", DAY, 1.5), ("b", DAY, 1.6), ("b", dt.date(2024, 1, 2), 1.7)]
    assert [(r.line, r.unread, r.exchange) for r in got.rejects.collect()] == [("2024-01-02,2,1,oops,1.5", ["Open"], "a")]
    # the plain reader takes the first line of a file for its header, whatever it holds
    assert SF.read_crypto_rates(spark, f"{scratch}/cur").where("exchange = 'b'").count() == 1
    one = C.read_checked(spark, "ohlc", f"{scratch}/cur/exchange=a")
    assert one.good.count() + one.rejects.count() == 2


def test_quoted_text_dates(spark, scratch):
    put(f"{scratch}/inv/asset=USD/quote=UAH/a.csv",
        '"Date","Price","Open","High","Low","Vol.","Change %"\n'
        '"01/02/2024","40.1","40.0","40.5","39.9","1.2K","0.5%"\n'
        '"01/03/2024","1,040.2","40.1","40.6","40.0","","-0.1%"\n'
        '"01/04/2024","40.2","40.1","40.6","40.0","a ""b"", c","-0.1%"\n')
    got = C.read_checked(spark, "investing", f"{scratch}/inv")
    assert rows(got.good, "Date", "Price", "Vol") == [("01/02/2024", 40.1, "1.2K"), ("01/04/2024", 40.2, 'a "b", c')]
    assert [r.unread for r in got.rejects.collect()] == [["Price", "Vol"]] or [r.unread[0] for r in got.rejects.collect()] == ["Price"]


def test_jobs_write_the_rejects(spark, scratch):
    put(f"{scratch}/cl/asset=USD/quote=UAH/a.csv", "\n".join(GOOD + BAD))
    jobs.main(["closed-rates", "--currencylayer", f"{scratch}/cl", "--out", f"{scratch}/out", "--rejects", f"{scratch}/rejects"])
    out = spark.read.parquet(f"{scratch}/out/{jobs.CLOSED_RATES_TABLE}")
    assert out.where("date IS NULL").count() == 0 and out.select("date").distinct().count() == 3
    assert spark.read.parquet(f"{scratch}/rejects/{jobs.CLOSED_RATES_TABLE}").count() == len(BAD)


# ---- exports -------------------------------------------------------------------------------

COLS = SF.BINANCE_TRADE_COLUMNS
VALUES = {"Date(UTC)": "2024-01-01 00:00:00", "Pair": "BTCUSDT", "Side": "BUY", "Price": "30000", "Executed": "2BTC",
          "Amount": "60,000USDT", "Fee": "0.1BNB"}


def export(path, order, values=(VALUES,), names=None, extra=()):
    names = names or {}
    cell = lambda v: f'"{v}"' if "," in v else v
    text = ",".join([names.get(c, c) for c in order] + list(extra)) + "\n"
    for v in values:
        text += ",".join([cell(v[c]) for c in order] + ["zzz"] * len(extra)) + "\n"
    put(path, text)
    return text


def test_exports_with_swapped_columns_are_aligned(spark, scratch):
    second = VALUES | {"Side": "SELL", "Price": "31000"}
    export(f"{scratch}/t/a.csv", COLS)
    export(f"{scratch}/t/b.csv", tuple(reversed(COLS)), (second, second))
    export(f"{scratch}/t/c.csv", COLS, (VALUES,), names={"Date(UTC)": "date (utc)", "Executed": "Filled"}, extra=("Note", "Id"))
    got = C.read_aligned_exports(spark, f"{scratch}/t/*.csv", COLS, aliases={"Executed": ["filled"]})
    assert got.columns == list(COLS)
    want = Counter([tuple(VALUES[c] for c in COLS)] * 2 + [tuple(second[c] for c in COLS)] * 2)
    assert Counter(tuple(r) for r in got.collect()) == want
    # read by position, the swapped file's columns would be mixed up
    by_place = SF.read_trade_exports(spark, f"{scratch}/t/*.csv", COLS)
    assert Counter(tuple(r) for r in by_place.collect()) != want


def test_headers_repeated_within_a_file_are_no_rows(spark, scratch):
    text = export(f"{scratch}/t/a.csv", COLS)
    put(f"{scratch}/t/a.csv", text + text + "\n" + text)
    assert C.read_aligned_exports(spark, f"{scratch}/t", COLS).count() == 3


@pytest.mark.parametrize("case", ["missing column", "no header", "two orders"])
def test_files_without_a_usable_header_are_errors(spark, scratch, case):
    export(f"{scratch}/t/good.csv", COLS)
    if case == "missing column":
        export(f"{scratch}/t/bad.csv", COLS[:-1])
    elif case == "no header":
        put(f"{scratch}/t/bad.csv", "2024-01-01 00:00:00,BTCUSDT,BUY,1,2BTC,3USDT,0\n")
    else:
        put(f"{scratch}/t/bad.csv", export(f"{scratch}/x/1.csv", COLS) + export(f"{scratch}/x/2.csv", tuple(reversed(COLS))))
    with pytest.raises(C.HeaderError, match="bad.csv") as error:
        C.read_aligned_exports(spark, f"{scratch}/t/*.csv", COLS)
    assert "good.csv" not in str(error.value)


def test_a_file_split_over_tasks_keeps_its_header(spark, scratch):
    values = [VALUES | {"Price": str(i)} for i in range(3000)]
    export(f"{scratch}/t/a.csv", tuple(reversed(COLS)), values)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = C.read_aligned_exports(spark, f"{scratch}/t", COLS)
        assert sorted(int(r.Price) for r in got.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_aligned_exports_feed_the_trades(spark, scratch):
    export(f"{scratch}/t/a.csv", tuple(reversed(COLS)))
    symbols = spark.createDataFrame([("BTCUSDT", "BTC", "USDT")], "symbol string, baseAsset string, quoteAsset string")
    [trade] = TR.normalise_trades(C.read_aligned_exports(spark, f"{scratch}/t", COLS), TR.BINANCE, symbols).collect()
    assert (trade.baseAsset, trade.side, trade.price, trade.date) == ("BTC", "BUY", 30000.0, DAY)
