"""Rate and trade inputs derived from the driver's tables.

The rate feeds and trade exports the jobs read are not part of the test data,
so they are derived, deterministically, from ``events``, ``lineitem`` and
``orders`` (rules in FIXTURES.md).  Every view has a Spark form (DataFrame
code) and a DuckDB form (SQL text used by the oracles); both must give the
same rows.  Only ``max`` / ``min`` are used to aggregate, so no result depends
on summation order.

The mapping tables below are fixture rules of this repository, not values of
the original job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixture rules (fixed values).
# event_type -> asset currency
EVENT_ASSET = {"view": "USD", "click": "BTC", "purchase": "SOL", "signup": "EUR", "error": "USDT"}
# user_id % 5 -> quote currency
USER_QUOTE = ["UAH", "CZK", "USD", "EUR", "BTC"]
# l_partkey % 3 -> base asset of a trade; l_suppkey % 2 -> quote asset of a trade
TRADE_BASE = ["BTC", "SOL", "EUR"]
TRADE_QUOTE = ["USD", "BTC"]
# l_returnflag -> side of an exchange-A trade
RETURNFLAG_SIDE = {"A": "BUY", "R": "SELL", "N": "HOLD"}
# o_orderstatus -> type of an exchange-B trade
ORDERSTATUS_TYPE = {"F": "buy", "O": "sell", "P": "cancel"}
# first day of the trade calendar; trades fall on the 30 days from it
TRADE_EPOCH = "2024-01-01"
# user_id % 2 -> exchange of the multi-exchange feed
USER_EXCHANGE = ["binance", "kraken"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, spread round-robin over the session's cores.

    The test files are single parquet row groups, which Spark cannot split.  The
    spread is part of these test views only, at every size alike; the jobs read
    their files as they are.  The files never change, so their footers are read for the
    schema once a process, not once a view.
    """
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.read.schema(_SCHEMAS[path]) if path in _SCHEMAS else spark.read
    df = reader.parquet(path)
    _SCHEMAS[path] = df.schema
    return df.repartition(spark.sparkContext.defaultParallelism)


_SCHEMAS: dict[str, StructType] = {}


def _lookup(key: Column, mapping: dict | list) -> Column:
    items = mapping.items() if isinstance(mapping, dict) else enumerate(mapping)
    expr = None
    for k, v in items:
        expr = (F.when(key == F.lit(k), F.lit(v)) if expr is None
                else expr.when(key == F.lit(k), F.lit(v)))
    return expr


def _sql_lookup(key: str, mapping: dict | list) -> str:
    items = mapping.items() if isinstance(mapping, dict) else enumerate(mapping)
    whens = " ".join(
        f"WHEN {key} = {k!r} THEN '{v}'" if isinstance(k, str) else f"WHEN {key} = {k} THEN '{v}'"
        for k, v in items)
    return f"CASE {whens} END"


def _int_text(c: Column) -> Column:
    return F.floor(c).cast("bigint").cast("string")


# --------------------------------------------------------------------- events

def _event_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    asset, quote = _lookup(F.col("event_type"), EVENT_ASSET), _lookup(F.col("user_id") % 5, USER_QUOTE)
    # no pair of a currency with itself: such an event is quoted in the next currency
    other = _lookup((F.col("user_id") + 1) % 5, USER_QUOTE)
    return ev.select(
        asset.alias("asset"),
        F.when(asset == quote, other).otherwise(quote).alias("quote"),
        F.to_date("ts").alias("date"),
        F.dayofmonth("ts").alias("dom"),
        (F.col("user_id") % 5).alias("uq"),
        "user_id",
        "value",
    )


def _moved(days) -> Column:
    """The event's date moved back by some days: no event is left out, and the days moved from are gaps."""
    return F.date_sub("date", days.cast("int")).alias("date")


def _gap_days() -> Column:
    return F.greatest((F.col("dom") + F.col("uq")) % 9 - 4, F.lit(0))


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rates ``asset, quote, date, rate``; unique keys, 4-day gaps, every event used."""
    ev = _event_currencies(spark, sf_dir)
    return (ev.withColumn("date", _moved(_gap_days())).groupBy("asset", "quote", "date")
            .agg(F.max("value").alias("rate")))


def fx_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``fx`` with one quote per user and no day rule: many pairs, for timing."""
    ev = _event_currencies(spark, sf_dir)
    return (ev.select("asset", F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("quote"),
                      "date", "value")
            .groupBy("asset", "quote", "date")
            .agg(F.max("value").alias("rate")))


def ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary OHLC feed ``Timestamp, High, Low, Open, Close, asset, quote`` from ``fx`` keys.

    Close is the ``fx`` rate; High = Close, Low = Open = the day's minimum.
    USDT stays USDT here: it is folded into USD only when feeds are reconciled.
    """
    ev = _event_currencies(spark, sf_dir)
    return (ev.withColumn("date", _moved(_gap_days())).groupBy("asset", "quote", "date")
            .agg(F.max("value").alias("Close"), F.min("value").alias("Low"))
            .select(F.col("date").alias("Timestamp"), F.col("Close").alias("High"), "Low",
                    F.col("Low").alias("Open"), "Close", "asset", "quote"))


def crypto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-exchange OHLC feed ``exchange, Timestamp, High, Low, Open, Close, asset, quote``.

    As ``ohlc`` but per exchange (``user_id % 2``): a pair quoted on both
    exchanges on a day has two rows for that day once the exchange is dropped.
    """
    ev = _event_currencies(spark, sf_dir).withColumn("exchange", _lookup(F.col("user_id") % 2, USER_EXCHANGE))
    return (ev.withColumn("date", _moved(_gap_days())).groupBy("exchange", "asset", "quote", "date")
            .agg(F.max("value").alias("Close"), F.min("value").alias("Low"))
            .select("exchange", F.col("date").alias("Timestamp"), F.col("Close").alias("High"), "Low",
                    F.col("Low").alias("Open"), "Close", "asset", "quote"))


def mkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secondary feed ``asset, quote, dt, price, high, low``; ``dt`` is MM/dd/yyyy text."""
    ev = _event_currencies(spark, sf_dir).withColumn(
        "asset", F.when(F.col("asset") == "USDT", F.lit("USD")).otherwise(F.col("asset")))
    return (ev.withColumn("date", _moved(F.when((F.col("dom") + 2 * F.col("uq")) % 4 == 0, 1).otherwise(0)))
            .groupBy("asset", "quote", "date")
            .agg(F.min("value").alias("price"), F.max("value").alias("high"),
                 F.min("value").alias("low"))
            .select("asset", "quote", F.date_format("date", "MM/dd/yyyy").alias("dt"),
                    "price", "high", "low"))


def investing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mkt`` in the secondary feed's own column names."""
    m = mkt(spark, sf_dir)
    return m.select(F.col("dt").alias("Date"), F.col("price").alias("Price"),
                    F.col("low").alias("Open"), F.col("high").alias("High"),
                    F.col("low").alias("Low"), F.lit(None).cast("string").alias("Vol"),
                    F.lit(None).cast("string").alias("Change"), "asset", "quote")


def ohlc_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``ohlc`` over all events, with repeated rows and NULL and zero closes on some days, and gaps."""
    ev = _event_currencies(spark, sf_dir)
    day = F.dayofmonth("date")
    daily = (ev.withColumn("date", _moved(F.when(day % 9 == 4, 1).otherwise(0))).groupBy("asset", "quote", "date")
             .agg(F.max("value").alias("v"), F.min("value").alias("Low")))
    close = F.when(day % 7 == 0, F.lit(None)).when(day % 5 == 0, F.lit(0.0)).otherwise(F.col("v"))
    return daily.select(F.col("date").alias("Timestamp"), F.col("v").alias("High"), "Low", F.col("Low").alias("Open"),
                        close.cast("double").alias("Close"), "asset", "quote",
                        F.explode(F.sequence(F.lit(1), F.when(day % 3 == 0, 3).otherwise(1))).alias("copy")).drop("copy")


def investing_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``investing`` over all events, with repeated rows and NULL and zero prices on some days."""
    ev = _event_currencies(spark, sf_dir).withColumn(
        "asset", F.when(F.col("asset") == "USDT", F.lit("USD")).otherwise(F.col("asset")))
    day = F.dayofmonth("date")
    daily = (ev.withColumn("date", _moved(F.when(day % 4 == 0, 1).otherwise(0))).groupBy("asset", "quote", "date")
             .agg(F.min("value").alias("v")))
    price = F.when(day % 11 == 0, F.lit(None)).when(day % 13 == 0, F.lit(0.0)).otherwise(F.col("v"))
    return daily.select(F.date_format("date", "MM/dd/yyyy").alias("Date"), price.cast("double").alias("Price"), "asset", "quote",
                        F.explode(F.sequence(F.lit(1), F.when(day % 2 == 0, 2).otherwise(1))).alias("copy")).drop("copy")


def klines_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One kline batch per ``ohlc`` row, as exchange JSON text in column ``value``.

    ``[[openTimeMs, "open", "high", "low", "close", "volume", closeTimeMs]]``;
    prices as 8-decimal text.
    """
    o = ohlc(spark, sf_dir)
    open_ms = F.unix_millis(F.col("Timestamp").cast("timestamp"))

    def q(c: str) -> Column:
        return F.concat(F.lit('"'), F.format_string("%.8f", F.col(c)), F.lit('"'))

    return o.select(F.concat(
        F.lit("[["), open_ms.cast("string"), F.lit(","), q("Open"), F.lit(","), q("High"),
        F.lit(","), q("Low"), F.lit(","), q("Close"), F.lit(',"0.00000000",'),
        (open_ms + F.lit(86399999)).cast("string"), F.lit("]]")).alias("value"))


# ------------------------------------------------------------------- lineitem

def trades_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange-A trade export (all STRING) plus the line keys ``l_orderkey, l_linenumber``."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_tax", "l_returnflag")
    b = _lookup(F.col("l_partkey") % 3, TRADE_BASE)
    q, other = (_lookup((F.col("l_suppkey") + k) % 2, TRADE_QUOTE) for k in (0, 1))
    li = li.select("*", b.alias("b"), F.when(b == q, other).otherwise(q).alias("q"))
    day = F.date_add(F.lit(TRADE_EPOCH).cast("date"), (F.col("l_orderkey") % 30).cast("int"))
    return li.select(
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "),
                 F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":00:00")
                 ).alias("Date(UTC)"),
        F.concat("b", "q").alias("Pair"),
        _lookup(F.col("l_returnflag"), RETURNFLAG_SIDE).alias("Side"),
        F.concat(_int_text(F.col("l_extendedprice") / F.col("l_quantity")), F.col("q")).alias("Price"),
        F.concat(_int_text(F.col("l_quantity")), F.col("b")).alias("Executed"),
        F.concat(_int_text(F.col("l_extendedprice")), F.col("q")).alias("Amount"),
        F.concat(_int_text(F.col("l_tax") * 100), F.col("b")).alias("Fee"),
        "l_orderkey", "l_linenumber",
    )


def symbols_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange-info JSON documents (column ``value``), one per exchange-A trade line.

    Each lists the trade's symbol, with fields the reader must ignore.
    """
    t = trades_a(spark, sf_dir)
    base = F.regexp_extract("Executed", r"[A-Z]+$", 0)
    quote = F.regexp_extract("Amount", r"[A-Z]+$", 0)
    return t.select(F.concat(
        F.lit('{"timezone":"UTC","symbols":[{"symbol":"'), F.col("Pair"),
        F.lit('","status":"TRADING","baseAsset":"'), base,
        F.lit('","quoteAsset":"'), quote, F.lit('","orderTypes":["LIMIT"]}]}')).alias("value"))


# --------------------------------------------------------------------- orders

def trades_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange-B trade export (all STRING) plus ``o_orderkey``.

    Every 11th customer's pair is written without the ``_`` separator.
    """
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                "o_totalprice")
    b = _lookup(F.col("o_custkey") % 3, TRADE_BASE)
    q, other = (_lookup((F.col("o_orderkey") + k) % 2, TRADE_QUOTE) for k in (0, 1))
    o = o.select("*", b.alias("b"), F.when(b == q, other).otherwise(q).alias("q"))
    day = F.date_add(F.lit(TRADE_EPOCH).cast("date"), (F.col("o_orderkey") % 30).cast("int"))
    qty = (F.col("o_custkey") % 50) + 1
    sep = F.when(F.col("o_custkey") % 11 == 0, F.lit("")).otherwise(F.lit("_"))
    return o.select(
        F.concat(F.date_format(day, "dd.MM.yyyy"), F.lit(" "),
                 F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"), F.lit(":"),
                 F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0")).alias("Date/Time"),
        F.col("o_orderkey").cast("string").alias("Trade ID"),
        _lookup(F.col("o_orderstatus"), ORDERSTATUS_TYPE).alias("Type"),
        F.concat(F.col("b"), sep, F.col("q")).alias("Currency Pair"),
        qty.cast("string").alias("Amount"),
        _int_text(F.col("o_totalprice") / qty).alias("Price"),
        _int_text(F.col("o_totalprice")).alias("Total"),
        F.lit("taker").alias("Fee type"),
        F.lit("0").alias("Fee amount"),
        F.lit("0.3").alias("Fee %"),
        "o_orderkey",
    )


# ------------------------------------------------------------------ DuckDB SQL
# The same views as common table expressions over the pre-registered tables.

def _sql_event_currencies() -> str:
    return (
        "SELECT " + _sql_lookup("event_type", EVENT_ASSET) + " AS asset, "
        "CASE WHEN " + _sql_lookup("event_type", EVENT_ASSET) + " = " + _sql_lookup("user_id % 5", USER_QUOTE)
        + " THEN " + _sql_lookup("(user_id + 1) % 5", USER_QUOTE) + " ELSE " + _sql_lookup("user_id % 5", USER_QUOTE) + " END AS quote, "
        "CAST(ts AS DATE) AS date, dayofmonth(ts) AS dom, user_id % 5 AS uq, user_id, value "
        "FROM events")


SQL_VIEWS: dict[str, str] = {}

def _sql_moved(days: str, source: str = "ev") -> str:
    """The events with their date moved back by some days (column ``date`` replaced)."""
    return f"(SELECT * REPLACE (CAST(date - CAST({days} AS INTEGER) AS DATE) AS date) FROM {source})"


_SQL_GAPS = _sql_moved("greatest((dom + uq) % 9 - 4, 0)")

SQL_VIEWS["ev"] = _sql_event_currencies()

SQL_VIEWS["fx"] = (
    f"SELECT asset, quote, date, max(value) AS rate FROM {_SQL_GAPS} GROUP BY asset, quote, date")

SQL_VIEWS["fx_wide"] = (
    "SELECT asset, 'U' || CAST(user_id AS VARCHAR) AS quote, date, max(value) AS rate "
    "FROM ev GROUP BY 1, 2, 3")

SQL_VIEWS["ohlc"] = (
    "SELECT date AS \"Timestamp\", max(value) AS \"High\", min(value) AS \"Low\", "
    f"min(value) AS \"Open\", max(value) AS \"Close\", asset, quote FROM {_SQL_GAPS} GROUP BY asset, quote, date")

SQL_VIEWS["crypto"] = (
    "SELECT " + _sql_lookup("user_id % 2", USER_EXCHANGE) + " AS exchange, date AS \"Timestamp\", "
    "max(value) AS \"High\", min(value) AS \"Low\", min(value) AS \"Open\", max(value) AS \"Close\", "
    f"asset, quote FROM {_SQL_GAPS} GROUP BY 1, asset, quote, date")

SQL_VIEWS["mkt"] = (
    "SELECT asset, quote, strftime(date, '%m/%d/%Y') AS dt, min(value) AS price, "
    "max(value) AS high, min(value) AS low FROM ("
    "SELECT CASE WHEN asset = 'USDT' THEN 'USD' ELSE asset END AS asset, quote, date, dom, uq, "
    f"value FROM {_sql_moved('CASE WHEN (dom + 2 * uq) % 4 = 0 THEN 1 ELSE 0 END')}) "
    "GROUP BY asset, quote, date")

def _sql_other_quote(base_key: str, quote_key: str) -> str:
    own, other = (_sql_lookup(f"({quote_key} + {k}) % 2", TRADE_QUOTE) for k in (0, 1))
    return f"CASE WHEN {_sql_lookup(base_key, TRADE_BASE)} = {own} THEN {other} ELSE {own} END"


SQL_VIEWS["trades_a"] = (
    "SELECT strftime(DATE '" + TRADE_EPOCH + "' + CAST(l_orderkey % 30 AS INTEGER), '%Y-%m-%d') "
    "|| ' ' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00:00' AS \"Date(UTC)\", "
    "b || q AS \"Pair\", "
    + _sql_lookup("l_returnflag", RETURNFLAG_SIDE) + " AS \"Side\", "
    "CAST(CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS VARCHAR) || q AS \"Price\", "
    "CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || b AS \"Executed\", "
    "CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) || q AS \"Amount\", "
    "CAST(CAST(floor(l_tax * 100) AS BIGINT) AS VARCHAR) || b AS \"Fee\", "
    "l_orderkey, l_linenumber, b, q FROM ("
    "SELECT *, " + _sql_lookup("l_partkey % 3", TRADE_BASE) + " AS b, "
    + _sql_other_quote("l_partkey % 3", "l_suppkey") + " AS q FROM lineitem)")

SQL_VIEWS["trades_b"] = (
    "SELECT strftime(DATE '" + TRADE_EPOCH + "' + CAST(o_orderkey % 30 AS INTEGER), '%d.%m.%Y') "
    "|| ' ' || lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || ':' "
    "|| lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') AS \"Date/Time\", "
    "CAST(o_orderkey AS VARCHAR) AS \"Trade ID\", "
    + _sql_lookup("o_orderstatus", ORDERSTATUS_TYPE) + " AS \"Type\", "
    "b || CASE WHEN o_custkey % 11 = 0 THEN '' ELSE '_' END || q AS \"Currency Pair\", "
    "CAST(o_custkey % 50 + 1 AS VARCHAR) AS \"Amount\", "
    "CAST(CAST(floor(o_totalprice / (o_custkey % 50 + 1)) AS BIGINT) AS VARCHAR) AS \"Price\", "
    "CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS \"Total\", "
    "o_orderkey FROM ("
    "SELECT *, " + _sql_lookup("o_custkey % 3", TRADE_BASE) + " AS b, "
    + _sql_other_quote("o_custkey % 3", "o_orderkey") + " AS q FROM orders)")

SQL_VIEWS["ohlc_r"] = (
    "SELECT date AS \"Timestamp\", CASE WHEN day(date) % 7 = 0 THEN NULL WHEN day(date) % 5 = 0 THEN 0.0 ELSE v END AS \"Close\", "
    "asset, quote FROM (SELECT asset, quote, date, max(value) AS v, "
    "unnest(range(CASE WHEN day(date) % 3 = 0 THEN 3 ELSE 1 END)) AS copy "
    f"FROM {_sql_moved('CASE WHEN day(date) % 9 = 4 THEN 1 ELSE 0 END')} GROUP BY asset, quote, date)")

SQL_VIEWS["mkt_r"] = (
    "SELECT asset, quote, strftime(date, '%m/%d/%Y') AS dt, "
    "CASE WHEN day(date) % 11 = 0 THEN NULL WHEN day(date) % 13 = 0 THEN 0.0 ELSE v END AS price "
    "FROM (SELECT asset, quote, date, min(value) AS v, unnest(range(CASE WHEN day(date) % 2 = 0 THEN 2 ELSE 1 END)) AS copy FROM ("
    "SELECT CASE WHEN asset = 'USDT' THEN 'USD' ELSE asset END AS asset, quote, date, value "
    f"FROM {_sql_moved('CASE WHEN day(date) % 4 = 0 THEN 1 ELSE 0 END')}) GROUP BY asset, quote, date)")

# Which views each view reads, so a query can pull in only what it needs.
_SQL_DEPS = {"fx": ["ev"], "fx_wide": ["ev"], "ohlc": ["ev"], "crypto": ["ev"], "mkt": ["ev"], "ohlc_r": ["ev"], "mkt_r": ["ev"],
             "trades_a": [], "trades_b": [], "ev": []}


def sql_with(*views: str) -> str:
    """``WITH`` clause defining ``views`` (and what they read) for a DuckDB query."""
    order: list[str] = []

    def add(v: str) -> None:
        for d in _SQL_DEPS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    return "WITH " + ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in order) + "\n"
