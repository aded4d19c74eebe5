"""Trade exports of two exchanges -> one trade form -> valuation in reference currencies.

Both exports are header CSV with every column read as STRING.  Normalised
form (15 columns, ``TRADE_COLUMNS``):

``exchange, date, Pair, side, executed, amount, price, total_asset_purchased,
total_asset_sold, total_quote_spent, total_quote_returned, balance_asset,
balance_quote, baseAsset, quoteAsset``

``executed`` is the base quantity, ``amount`` the quote quantity net of the
exchange fee.  The two exchanges differ in more than column names; those
differences are kept (see ``ExchangeFormat``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.functions.columns import parse_date, split_part, strip_to_number, to_double
from ratesmith.functions.joins import broadcast_if_small
from ratesmith.session import cut_lineage

TRADE_COLUMNS = (
    "exchange", "date", "Pair", "side", "executed", "amount", "price",
    "total_asset_purchased", "total_asset_sold", "total_quote_spent", "total_quote_returned",
    "balance_asset", "balance_quote", "baseAsset", "quoteAsset",
)

# The reference currencies trades are valued in.
VALUATION_CURRENCIES = ("BTC", "USDT")

# Rows of the combined lookup up to which it is broadcast.  A built hash relation
# of such rows takes about 140 bytes a row (measured), so the bound is about 280 MB
# per executor for all currencies together: ten years of daily rates for 500 assets.
LOOKUP_BROADCAST_ROWS = 2_000_000
LOOKUP_ROW_BYTES = 140


@dataclass(frozen=True)
class ExchangeFormat:
    """How one exchange writes its trade export.

    ``sell_test_on_raw``: whether the SELL-only fields test the raw side text
    (an unknown side then counts neither as bought nor sold) or the normalised
    side (anything not BUY counts as sold).  ``spent_sign``: sign of
    ``total_quote_spent`` on a BUY.  ``strip_numbers``: numbers carry unit
    suffixes and separators that must be removed before the cast.
    """

    name: str
    buy: str
    sell: str
    side_col: str
    price_col: str
    base_qty_col: str
    quote_qty_col: str
    pair_col: str
    date_col: str
    date_format: str
    fee_factor: float
    strip_numbers: bool
    sell_test_on_raw: bool
    spent_sign: float
    pair_separator: str | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        """The export's columns that are read."""
        return (self.date_col, self.pair_col, self.side_col, self.price_col, self.base_qty_col, self.quote_qty_col)


# Export layouts of the two exchanges.
BINANCE = ExchangeFormat(
    name="binance", buy="BUY", sell="SELL", side_col="Side", price_col="Price",
    base_qty_col="Executed", quote_qty_col="Amount", pair_col="Pair",
    date_col="Date(UTC)", date_format="yyyy-MM-dd HH:mm:ss", fee_factor=0.999,
    strip_numbers=True, sell_test_on_raw=False, spent_sign=-1.0)

EXMO = ExchangeFormat(
    name="exmo", buy="buy", sell="sell", side_col="Type", price_col="Price",
    base_qty_col="Amount", quote_qty_col="Total", pair_col="Currency Pair",
    date_col="Date/Time", date_format="dd.MM.yyyy HH:mm", fee_factor=0.997,
    strip_numbers=False, sell_test_on_raw=True, spent_sign=1.0, pair_separator="_")


def normalise_trades(raw: DataFrame, fmt: ExchangeFormat, symbols: DataFrame | None = None) -> DataFrame:
    """One exchange's export -> ``TRADE_COLUMNS``.

    The pair is split on ``fmt.pair_separator`` when the format has one;
    otherwise ``symbols`` (``symbol, baseAsset, quoteAsset``) is inner-joined
    on the pair and trades of unknown symbols are dropped.  The symbol list of
    an exchange is small; it is broadcast when its estimated size allows.
    """
    c = F.col
    if fmt.pair_separator is None:
        if symbols is None:
            raise ValueError(f"{fmt.name}: a symbol table is needed to split pairs")
        sym = broadcast_if_small(symbols.select("symbol", "baseAsset", "quoteAsset"))
        raw = raw.join(sym, c(fmt.pair_col) == c("symbol"), "inner")
        base, quote = c("baseAsset"), c("quoteAsset")
    else:
        base = split_part(fmt.pair_col, fmt.pair_separator, 0)
        quote = split_part(fmt.pair_col, fmt.pair_separator, 1)

    number = strip_to_number if fmt.strip_numbers else to_double
    raw_side = c(fmt.side_col)
    is_buy = raw_side == F.lit(fmt.buy)
    side = F.when(is_buy, F.lit("BUY")).otherwise(F.lit("SELL"))
    is_sell = (raw_side == F.lit(fmt.sell)) if fmt.sell_test_on_raw else (side == F.lit("SELL"))
    executed = number(fmt.base_qty_col)
    amount = number(fmt.quote_qty_col) * F.lit(fmt.fee_factor)

    t = raw.select(
        F.lit(fmt.name).alias("exchange"),
        parse_date(fmt.date_col, fmt.date_format).alias("date"),
        c(fmt.pair_col).alias("Pair"),
        side.alias("side"),
        is_buy.alias("_buy"),
        is_sell.alias("_sell"),
        executed.alias("executed"),
        amount.alias("amount"),
        number(fmt.price_col).alias("price"),
        base.alias("baseAsset"),
        quote.alias("quoteAsset"),
    )
    zero = F.lit(0.0)
    buy, sell, ex, am = c("_buy"), c("_sell"), c("executed"), c("amount")
    return t.select(
        "exchange", "date", "Pair", "side", "executed", "amount", "price",
        F.when(buy, ex).otherwise(zero).alias("total_asset_purchased"),
        F.when(sell, ex).otherwise(zero).alias("total_asset_sold"),
        F.when(buy, am * F.lit(fmt.spent_sign)).otherwise(zero).alias("total_quote_spent"),
        F.when(sell, am).otherwise(zero).alias("total_quote_returned"),
        F.when(buy, ex).otherwise(-ex).alias("balance_asset"),
        F.when(buy, -am).otherwise(am).alias("balance_quote"),
        "baseAsset", "quoteAsset",
    )


def union_trades(*frames: DataFrame) -> DataFrame:
    """Stack normalised trades of several exchanges (by column name)."""
    out = frames[0].select(*TRADE_COLUMNS)
    for f in frames[1:]:
        out = out.unionByName(f.select(*TRADE_COLUMNS))
    return out


def _prefix(currency: str) -> str:
    return currency.lower()


def valuation_columns(currencies: Sequence[str] = VALUATION_CURRENCIES) -> list[str]:
    names = ["exchange", "date", "side", "baseAsset", "quoteAsset", "executed", "amount",
             "total_asset_purchased", "total_asset_sold", "total_quote_spent",
             "total_quote_returned", "balance_asset", "balance_quote", "price"]
    names += [f"{_prefix(cur)}_rate" for cur in currencies]
    for measure in ("balance_quote", "total_quote_spent", "total_quote_returned"):
        names += [f"{_prefix(cur)}_{measure}" for cur in currencies]
    return names


def valuation_lookup(rates_df: DataFrame, currencies: Sequence[str] = VALUATION_CURRENCIES) -> DataFrame:
    """``_date, _asset`` and one ``<currency>_rate`` per currency: the series joined on the rates' side.

    A key with m rates in one currency and n in another gives m * n rows, as joining
    trades with one series after the other would; a key missing from a series has NULL there.
    """
    out = None
    for cur in currencies:
        one = rates_df.where((F.col("quote") == F.lit(cur)) & F.col("asset").isNotNull() & F.col("date").isNotNull()).select(
            F.col("date").alias("_date"), F.col("asset").alias("_asset"),
            F.col("rate").cast("double").alias(f"{_prefix(cur)}_rate"))
        out = one if out is None else out.join(one, ["_date", "_asset"], "full_outer")
    return out


def value_trades(trades: DataFrame, rates_df: DataFrame,
                 currencies: Sequence[str] = VALUATION_CURRENCIES,
                 missing_rate: float | None = 1.0,
                 broadcast_rows: int = LOOKUP_BROADCAST_ROWS) -> DataFrame:
    """Value each trade in each reference currency.

    For currency C: the trade's base asset is looked up as ``baseAsset/C`` on
    the trade date (LEFT join; several rates for one key repeat the trade).
    ``C_balance_quote`` is the quote balance when the trade is quoted in C,
    else the base balance times the rate; likewise ``C_total_quote_spent``
    (from ``total_asset_purchased``) and ``C_total_quote_returned`` (from
    ``total_asset_sold``).  A missing rate counts as ``missing_rate`` (1 by
    default; ``None`` leaves the value NULL).

    Plan: the currencies' series are combined first (assets x days, without the
    trades) and written to the checkpoint folder, which runs a job while the
    result is being built; the trades are joined once.  The lookup is broadcast
    when it has at most ``broadcast_rows`` rows.  Beyond that the one join is a
    sort-merge join directly over two shuffles, whose skewed trade partitions
    adaptive execution splits.  Trades without a date or base asset cannot
    match and are spread over the partitions, by a hash of their values, instead of sharing one.
    """
    lookup = cut_lineage(valuation_lookup(rates_df, currencies), "valuation-lookup")
    small = lookup.count() <= broadcast_rows
    if small:
        t = trades.join(F.broadcast(lookup), (F.col("date") == F.col("_date")) & (F.col("baseAsset") == F.col("_asset")), "left")
    else:
        keyed = F.col("date").isNotNull() & F.col("baseAsset").isNotNull()
        # the salt is the row's own content: a task that runs again sends each row where it was sent before
        loose = F.when(~keyed, F.concat(F.lit("\0"), F.xxhash64(*trades.columns).cast("string")))
        t = trades.withColumn("_key", F.coalesce(loose, F.concat_ws("\1", F.col("date").cast("string"), "baseAsset")))
        lookup = lookup.withColumn("_lookup_key", F.concat_ws("\1", F.col("_date").cast("string"), "_asset"))
        t = t.join(lookup, F.col("_key") == F.col("_lookup_key"), "left")

    out = {}
    for cur in currencies:
        p = _prefix(cur)
        rate = F.col(f"{p}_rate")
        factor = rate if missing_rate is None else F.coalesce(rate, F.lit(float(missing_rate)))
        in_cur = F.col("quoteAsset") == F.lit(cur)

        def pick(own: str, other: str) -> Column:
            return F.when(in_cur, F.col(own)).otherwise(F.col(other) * factor)

        out[f"{p}_balance_quote"] = pick("balance_quote", "balance_asset")
        out[f"{p}_total_quote_spent"] = pick("total_quote_spent", "total_asset_purchased")
        out[f"{p}_total_quote_returned"] = pick("total_quote_returned", "total_asset_sold")
    return t.withColumns(out).select(*valuation_columns(currencies))
