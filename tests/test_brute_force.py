"""Operators against plain-Python brute force on random inputs with repeats and NULLs."""

import datetime as dt
import random
from collections import Counter

from ratesmith.operators import rates as R
from ratesmith.operators import trades as TR

PRIMARY = "Timestamp date, Close double, asset string, quote string"
SECONDARY = "Date string, Price double, asset string, quote string"


def norm(c):
    return "USD" if c == "USDT" else c


def test_reconcile_is_the_row_level_full_outer_join(spark):
    rnd = random.Random(3)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)] + [None]
    prim = [(rnd.choice(days), rnd.choice([None, 1.0, 2.0, 3.0]), rnd.choice(["BTC", "USDT", "EUR"]),
             rnd.choice(["USD", "USDT", "BTC"])) for _ in range(120)]
    sec = []
    for _ in range(120):
        d = rnd.choice(days)
        text = rnd.choice(["bad", None]) if d is None else d.strftime("%m/%d/%Y")
        sec.append((text, rnd.choice([None, 5.0, 6.0]), rnd.choice(["BTC", "EUR", "USDT"]),
                    rnd.choice(["USD", "BTC"])))
    got = Counter(tuple(r) for r in R.reconcile_feeds(spark.createDataFrame(prim, PRIMARY),
                                                      spark.createDataFrame(sec, SECONDARY)).collect())

    def parse(t):
        try:
            return dt.datetime.strptime(t, "%m/%d/%Y").date()
        except (TypeError, ValueError):
            return None

    left = [(norm(a), norm(q), d, v) for d, v, a, q in prim]
    right = [(a, q, parse(t), v) for t, v, a, q in sec]
    want = Counter()
    matched_r = set()
    for la, lq, ld, lv in left:
        hit = False
        for j, (ra, rq, rd, rv) in enumerate(right):
            if None not in (la, lq, ld) and (la, lq, ld) == (ra, rq, rd):
                hit = True
                matched_r.add(j)
                want[(ra, rq, ld, lv if lv is not None else rv)] += 1
        if not hit:
            want[(la, lq, ld, lv)] += 1
    for j, (ra, rq, rd, rv) in enumerate(right):
        if j not in matched_r:
            want[(ra, rq, rd, rv)] += 1
    assert got == want


def test_valuation_is_two_left_joins(spark):
    rnd = random.Random(9)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    assets = ["BTC", "ETH", "SOL"]
    trades = spark.createDataFrame(
        [("x", rnd.choice(days), "p", "BUY", 1.0, 2.0, 1.0, float(i), 0.0, -2.0, 0.0, float(i), -2.0,
          rnd.choice(assets), rnd.choice(["BTC", "USDT", "EUR"])) for i in range(60)],
        ", ".join(f"{c} {'date' if c == 'date' else 'double' if c not in ('exchange', 'Pair', 'side', 'baseAsset', 'quoteAsset') else 'string'}"
                  for c in TR.TRADE_COLUMNS))
    rate_rows = [(rnd.choice(assets), rnd.choice(["BTC", "USDT"]), rnd.choice(days), float(rnd.randint(1, 4)))
                 for _ in range(10)]
    rates = spark.createDataFrame(rate_rows, "asset string, quote string, date date, rate double")
    got = Counter((r.total_asset_purchased, r.btc_rate, r.usdt_rate, r.btc_balance_quote, r.usdt_balance_quote)
                  for r in TR.value_trades(trades, rates).collect())
    want = Counter()
    for t in trades.collect():
        btc = [r for a, q, d, r in rate_rows if (a, q, d) == (t.baseAsset, "BTC", t.date)] or [None]
        usdt = [r for a, q, d, r in rate_rows if (a, q, d) == (t.baseAsset, "USDT", t.date)] or [None]
        for b in btc:
            for u in usdt:
                bq = t.balance_quote if t.quoteAsset == "BTC" else t.balance_asset * (b if b is not None else 1)
                uq = t.balance_quote if t.quoteAsset == "USDT" else t.balance_asset * (u if u is not None else 1)
                want[(t.total_asset_purchased, b, u, bq, uq)] += 1
    assert got == want


def test_latest_rates_against_brute_force(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["A", "B", None]), rnd.choice(["X", "Y"]),
             rnd.choice([dt.date(2024, 1, d) for d in (1, 2, 3)] + [None]), float(rnd.randint(0, 3)))
            for _ in range(80)]
    got = Counter(tuple(r) for r in R.latest_rates(
        spark.createDataFrame(rows, "asset string, quote string, date date, rate double")).collect())
    latest = {}
    for a, q, d, _ in rows:
        if d is not None:
            latest[(a, q)] = max(latest.get((a, q), d), d)
    want = Counter(r for r in rows if None not in (r[0], r[1], r[2]) and latest.get((r[0], r[1])) == r[2])
    assert got == want


def test_currency_filter_before_reconciliation_equals_filter_after(spark):
    rnd = random.Random(8)
    days = [dt.date(2024, 1, d) for d in (1, 2)] + [None]
    cur = ["BTC", "USDT", "USD", "EUR", "UAH", None]
    prim = [(rnd.choice(days), rnd.choice([None, 1.0, 2.0]), rnd.choice(cur), rnd.choice(cur)) for _ in range(150)]
    sec = [(rnd.choice(["01/01/2024", "01/02/2024", "bad"]), rnd.choice([None, 5.0]), rnd.choice(cur),
            rnd.choice(cur)) for _ in range(150)]
    p, s = spark.createDataFrame(prim, PRIMARY), spark.createDataFrame(sec, SECONDARY)
    listed = ["USD", "UAH"]
    before = Counter(tuple(r) for r in R.reconcile_feeds(p, s, currencies=listed).collect())
    after = Counter(tuple(r) for r in R.filter_currencies(R.reconcile_feeds(p, s), listed).collect())
    assert before == after and sum(before.values()) > 0


def test_weighted_market_rates_equal_the_bag_composition(spark):
    from ratesmith.operators.timeseries import fill_calendar
    from ratesmith.plans import assembly

    rnd = random.Random(12)
    days = [dt.date(2024, 1, d) for d in range(1, 12)]
    pairs = [("USD", "UAH"), ("USD", "CZK"), ("USDT", "UAH"), ("SOL", "USD"), ("BTC", "USDT"), ("EUR", "UAH")]
    prim = []
    for _ in range(220):
        a, q = rnd.choice(pairs)
        prim.append((rnd.choice(days), rnd.choice([None, 1.0, 2.0, 4.0]), a, q))
    sec = []
    for _ in range(160):
        a, q = rnd.choice([("USD", "UAH"), ("USD", "CZK"), ("BTC", "USD"), ("EUR", "UAH")])
        sec.append((rnd.choice(days).strftime("%m/%d/%Y"), rnd.choice([None, 3.0, 5.0]), a, q))
    p, s = spark.createDataFrame(prim, PRIMARY), spark.createDataFrame(sec, SECONDARY)

    # the composition over materialized bags, as the original runs it
    base = R.filter_currencies(R.reconcile_feeds(p, s), R.MARKET_CURRENCIES)
    u = base.unionByName(R.cross_rate_common_base(base))
    u = u.unionByName(R.cross_rate_chain(u))
    u = u.unionByName(R.inverse_rates(u))
    u = u.unionByName(R.identity_rates(u))
    want = Counter(tuple(r) for r in fill_calendar(u).collect())

    got = Counter(tuple(r) for r in assembly.market_rates(p, s, materialize=False).collect())
    assert got == want and len(want) > 50


def test_strip_to_number_matches_python_on_messy_text(spark):
    import re as _re

    from ratesmith.functions.columns import strip_to_number

    rnd = random.Random(21)
    alphabet = "0123456789..,-+eE BTCUSDT"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    texts += ["12.51INCH", "40,000.5USDT", "", ".", "1.", ".5", "1.2.3", "-7", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string")
           .select(strip_to_number("t")).collect()]

    def want(t):
        if t is None:
            return None
        digits = _re.sub(r"[^0-9.]", "", t)
        try:
            return float(digits)
        except ValueError:
            return None

    assert got == [want(t) for t in texts]
