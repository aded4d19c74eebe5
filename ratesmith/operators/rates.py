"""Rate operators: projections, feed reconciliation, derived rates, aggregates.

A *rates frame* has the columns ``asset, quote, date, rate``: the price of one
``asset`` in ``quote`` on ``date``.  Every function takes and returns
DataFrames; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratesmith.functions.columns import (
    repeat_rows,
    either_side_in,
    normalise_stablecoin,
    pair_in,
    parse_date,
    safe_inverse,
    safe_ratio,
)

RATE_COLUMNS = ("asset", "quote", "date", "rate")

# Fixed values of the market-rate assembly (defaults; every function takes them
# as parameters).
MARKET_CURRENCIES = ("USD", "EUR", "UAH", "CZK", "BTC")
# (new asset, new quote, common base): rate = base/new_quote divided by base/new_asset
COMMON_BASE_TRIPLETS = (("CZK", "UAH", "USD"),)
# (asset, quote, middle): rate = asset/middle times middle/quote
CHAIN_TRIPLETS = (("SOL", "UAH", "USD"), ("BTC", "CZK", "USD"))
# pairs whose inverse is added
INVERSE_PAIRS = (
    ("CZK", "UAH"), ("USD", "UAH"), ("USD", "CZK"), ("BTC", "USD"), ("BTC", "UAH"),
    ("BTC", "EUR"), ("BTC", "CZK"), ("EUR", "CZK"), ("EUR", "UAH"),
)
# high-water mark of a pair that has no rows yet
HIGH_WATER_DEFAULT = "2015-01-01"
PRIMARY_DATE_FORMAT = "yyyy-MM-dd"
SECONDARY_DATE_FORMAT = "MM/dd/yyyy"


def rates(df: DataFrame) -> DataFrame:
    """Select the rates columns in their canonical order."""
    return df.select(*RATE_COLUMNS)


def _as_date(df: DataFrame, c: str, fmt: str) -> F.Column:
    """DATE passes through, TIMESTAMP drops its time, text is parsed with ``fmt``
    (NULL if it does not parse)."""
    dtype = df.schema[c].dataType.typeName()
    if dtype == "date":
        return F.col(c)
    if dtype.startswith("timestamp"):
        return F.to_date(c)
    return parse_date(c, fmt)


# ------------------------------------------------------------------ projections

def close_rates(ohlc: DataFrame, date_col: str = "Timestamp", close_col: str = "Close") -> DataFrame:
    """Daily OHLC rows -> rates with ``rate = Close``.

    Any ``exchange`` column is dropped, so one pair quoted on two exchanges
    gives two rows per key.
    """
    return ohlc.select("asset", "quote",
                       _as_date(ohlc, date_col, PRIMARY_DATE_FORMAT).alias("date"),
                       F.col(close_col).cast("double").alias("rate"))


def dated_prices(prices: DataFrame, date_col: str = "Date", price_col: str = "Price",
                 fmt: str = SECONDARY_DATE_FORMAT) -> DataFrame:
    """Text-dated prices with the parsed date and its year; no aggregation.

    Columns (the original's names): ``asset, quote, year, the_date, Price, Date, High, Low``
    where ``Date`` is the text and ``the_date`` the parsed date.
    """
    the_date = _as_date(prices, date_col, fmt)
    return prices.select(
        "asset", "quote", F.year(the_date).alias("year"), the_date.alias("the_date"),
        F.col(price_col).cast("double").alias("Price"), F.col(date_col).alias("Date"),
        F.col("High").cast("double").alias("High"), F.col("Low").cast("double").alias("Low"))


def normalise_pair(df: DataFrame, asset: str = "asset", quote: str = "quote") -> DataFrame:
    """Fold the stablecoin into its fiat currency on both sides of the pair."""
    return df.withColumns({asset: normalise_stablecoin(asset), quote: normalise_stablecoin(quote)})


def filter_currencies(df: DataFrame, currencies: Iterable[str] = MARKET_CURRENCIES) -> DataFrame:
    """Rows whose asset or quote is one of ``currencies``."""
    return df.where(either_side_in(currencies))


# ------------------------------------------------------------ multiplicities
# The original's joins and unions keep every copy of a row (a bag).  Where a
# result is only used through a distinct, or through per-day row counts, the
# copies are carried as a weight column instead of as rows: joins then pair
# weighted rows (multiplying weights) rather than every pair of copies within
# a key, and nothing is expanded.

WEIGHT = "_w"
# Flag (1) of rows of weight 0 that count as one copy together, however often they occur.
ONCE = "_once"


def with_weight(rates_df: DataFrame) -> DataFrame:
    """A rates frame with a multiplicity column (1 per row when it has none)."""
    if WEIGHT in rates_df.columns:
        return rates_df
    return rates_df.withColumn(WEIGHT, F.lit(1).cast("long"))


def expand_counts(df: DataFrame, *count_cols: str) -> DataFrame:
    """Repeat each row ``product(count_cols)`` times (64-bit counts, see :func:`repeat_rows`)."""
    for c in count_cols:
        df = repeat_rows(df, c)
    return df


def _finish(df: DataFrame, factors: tuple[str, str], weights: bool) -> DataFrame:
    """Rows with two multiplicity factors -> a weighted frame or the bag of rows."""
    a, b = factors
    if weights:
        return df.select(*RATE_COLUMNS, (F.col(a) * F.col(b)).cast("long").alias(WEIGHT))
    return expand_counts(df, a, b).select(*RATE_COLUMNS)


# ---------------------------------------------------------------------- joins

def reconcile_feeds(primary: DataFrame, secondary: DataFrame,
                    primary_date: str = "Timestamp", primary_rate: str = "Close",
                    secondary_date: str = "Date", secondary_rate: str = "Price",
                    secondary_fmt: str = SECONDARY_DATE_FORMAT,
                    currencies: Iterable[str] | None = None, weights: bool = False) -> DataFrame:
    """FULL OUTER join of two daily feeds on (asset, quote, date).

    The primary side's pair is stablecoin-normalised, the secondary's is
    used as is; the secondary's dates are text in ``secondary_fmt``.  The rate
    is the primary close, else the secondary price.  Output is the exact bag of
    the row-level join: a key with ``m`` primary and ``n`` secondary rows gives
    ``m * n`` rows; rows with a NULL key never match.  With ``weights`` the
    bag comes as distinct-value rows with their multiplicity in ``WEIGHT``.

    With ``currencies`` only keys with a listed asset or quote are kept.  The
    filter is applied to each feed before the join: rows that match share
    their key, so they pass or fail together and the result equals filtering
    the joined rows, but a filter on a FULL OUTER join's output cannot reach
    the scans, while this one prunes the feeds' ``asset=/quote=`` folders.

    Plan: each side is first counted per (key, value), which collapses repeated
    keys map-side, so the join shuffles at most one row per distinct value and a
    hot key cannot pile up in one join task; the counts are multiplied, or
    expanded, after the join.
    """
    if currencies is not None:
        listed = list(currencies)
        primary = primary.where(normalise_stablecoin("asset").isin(listed)
                                | normalise_stablecoin("quote").isin(listed))
        secondary = secondary.where(either_side_in(listed))
    left = (primary.select(normalise_stablecoin("asset").alias("asset"),
                           normalise_stablecoin("quote").alias("quote"),
                           _as_date(primary, primary_date, PRIMARY_DATE_FORMAT).alias("date"),
                           F.col(primary_rate).cast("double").alias("value"))
            .groupBy("asset", "quote", "date", "value").agg(F.count(F.lit(1)).alias("n")))
    right = (secondary.select("asset", "quote",
                              _as_date(secondary, secondary_date, secondary_fmt).alias("date"),
                              F.col(secondary_rate).cast("double").alias("value"))
             .groupBy("asset", "quote", "date", "value").agg(F.count(F.lit(1)).alias("n")))
    l, r = left.alias("l"), right.alias("r")
    on = ((F.col("l.asset") == F.col("r.asset")) & (F.col("l.quote") == F.col("r.quote"))
          & (F.col("l.date") == F.col("r.date")))
    joined = l.join(r, on, "full_outer").select(
        F.coalesce(F.col("r.asset"), F.col("l.asset")).alias("asset"),
        F.coalesce(F.col("r.quote"), F.col("l.quote")).alias("quote"),
        F.coalesce(F.col("l.date"), F.col("r.date")).alias("date"),
        F.coalesce(F.col("l.value"), F.col("r.value")).alias("rate"),
        F.coalesce(F.col("l.n"), F.lit(1)).alias("nl"),
        F.coalesce(F.col("r.n"), F.lit(1)).alias("nr"))
    return _finish(joined, ("nl", "nr"), weights)


def _cross(rates_df: DataFrame, specs, combine, weights: bool) -> DataFrame:
    """For each (asset, quote, src pair, trg pair): join the two pairs' rows on date.

    A generator tags every row with the legs it fills; the source legs are then joined with
    the target legs once on (derivation, date), so the plan has two scans and one join
    however many derivations there are.  Weighted rows pair as they are (copies are
    already weights; the weights multiply); plain rows give the bag of the row-level join.
    """
    if weights:
        rates_df = with_weight(rates_df)
    if not specs:
        empty = rates_df.select(*RATE_COLUMNS).where(F.lit(False))
        return with_weight(empty) if weights else empty

    def legs(which: int, name: str) -> DataFrame:
        wanted = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(spec[which][0]).alias("a"), F.lit(spec[which][1]).alias("q"))
                           for k, spec in enumerate(specs)])
        filled = F.filter(wanted, lambda w: (w["a"] == F.col("asset")) & (w["q"] == F.col("quote")))
        weight = [F.col(WEIGHT).alias(f"{name}_w")] if weights else []
        return (rates_df.where(pair_in([spec[which] for spec in specs])).withColumn("leg", F.explode(filled))
                .select(F.col("leg.k").alias("k"), "date", F.col("rate").cast("double").alias(f"{name}_rate"), *weight))

    new = [F.array(*[F.lit(spec[i]) for spec in specs]) for i in range(2)]
    w = [(F.col("src_w") * F.col("trg_w")).alias(WEIGHT)] if weights else []
    return legs(2, "src").join(legs(3, "trg"), ["k", "date"]).select(
        F.get(new[0], F.col("k")).alias("asset"), F.get(new[1], F.col("k")).alias("quote"), "date",
        combine(F.col("trg_rate"), F.col("src_rate")).alias("rate"), *w)


def cross_rate_common_base(rates_df: DataFrame,
                           triplets: Sequence[tuple[str, str, str]] = COMMON_BASE_TRIPLETS,
                           weights: bool = False) -> DataFrame:
    """For (X, Y, B): ``X/Y = rate(B/Y) / rate(B/X)`` on each date both exist.

    Each side is a single pair, selected by a filter that reaches the scan.
    The result is the bag of the row-level join; with ``weights`` the input's
    copies are a multiplicity column and the joined rows carry the product, so
    repeated rows are never paired copy by copy.
    """
    specs = [(x, y, (b, x), (b, y)) for x, y, b in triplets]
    return _cross(rates_df, specs, safe_ratio, weights)


def cross_rate_chain(rates_df: DataFrame,
                     triplets: Sequence[tuple[str, str, str]] = CHAIN_TRIPLETS,
                     weights: bool = False) -> DataFrame:
    """For (X, Y, M): ``X/Y = rate(X/M) * rate(M/Y)`` on each date both exist (as above)."""
    specs = [(x, y, (x, m), (m, y)) for x, y, m in triplets]
    return _cross(rates_df, specs, lambda trg, src: trg * src, weights)


def latest_rates(rates_df: DataFrame) -> DataFrame:
    """Each pair's rows on its latest date; ties are all kept.

    The per-pair maximum is a partial aggregate (one row per pair leaves each
    map task) and the rows are then semi-joined on (asset, quote, date); the
    small side is broadcast by adaptive execution when its measured size allows.
    Rows with a NULL asset, quote or date never match.
    """
    latest = rates_df.groupBy("asset", "quote").agg(F.max("date").alias("date"))
    return rates_df.join(latest, ["asset", "quote", "date"], "left_semi").select(*RATE_COLUMNS)


# ------------------------------------------------------------- derived rates

def inverse_rates(rates_df: DataFrame, pairs: Sequence[tuple[str, str]] = INVERSE_PAIRS) -> DataFrame:
    """``(quote, asset, date, 1/rate)`` for rows whose pair is listed; NULL for a zero rate.

    A multiplicity column, if present, is kept.
    """
    extra = [WEIGHT] if WEIGHT in rates_df.columns else []
    return rates_df.where(pair_in(pairs)).select(
        F.col("quote").alias("asset"), F.col("asset").alias("quote"), "date",
        safe_inverse("rate").alias("rate"), *extra)


def identity_rates(rates_df: DataFrame) -> DataFrame:
    """Distinct ``(asset, asset, date, 1.0)``; a currency seen only as quote gets none."""
    return rates_df.select("asset", F.col("asset").alias("quote"), "date",
                           F.lit(1.0).alias("rate")).dropDuplicates()


def with_inverses_and_identities(rates_df: DataFrame, pairs: Sequence[tuple[str, str]] = INVERSE_PAIRS) -> DataFrame:
    """Weighted rows, the inverses of the listed pairs, and the identities of all their assets, in one pass.

    One generator per row instead of a union of re-reads.  The same rows as
    ``rows + inverse_rates(rows)`` followed by ``+ identity_rates(...)``: identities are
    distinct there, so here they have weight 0 and the flag ``ONCE``, which adds one copy per key.
    """
    rates_df = with_weight(rates_df)

    def row(asset, quote, rate, weight, once):
        return F.struct(asset.alias("asset"), quote.alias("quote"), rate.cast("double").alias("rate"),
                        weight.cast("long").alias(WEIGHT), F.lit(once).alias(ONCE))

    asset, quote, rate, weight = F.col("asset"), F.col("quote"), F.col("rate"), F.col(WEIGHT)
    one, none, listed = F.lit(1.0), F.lit(0), pair_in(pairs)
    rows = F.array(row(asset, quote, rate, weight, 0), row(asset, asset, one, none, 1),
                   F.when(listed, row(quote, asset, safe_inverse("rate"), weight, 0)),
                   F.when(listed, row(quote, quote, one, none, 1)))
    return rates_df.select("date", F.inline(F.filter(rows, lambda r: r.isNotNull()))).select(*RATE_COLUMNS, WEIGHT, ONCE)


def distinct_rates(df: DataFrame) -> DataFrame:
    """Full-row distinct (NULLs compare equal); partial dedupe happens map-side."""
    return df.dropDuplicates()


# ---------------------------------------------------------------- aggregates

def yearly_close_stats(ohlc: DataFrame, date_col: str = "Timestamp", close_col: str = "Close",
                       fmt: str = PRIMARY_DATE_FORMAT) -> DataFrame:
    """Per asset, quote and year: first and last date, lowest and highest close."""
    return _yearly_stats(ohlc, _as_date(ohlc, date_col, fmt), F.col(close_col).cast("double"))


def yearly_price_stats(prices: DataFrame, date_col: str = "Date", price_col: str = "Price",
                       fmt: str = SECONDARY_DATE_FORMAT) -> DataFrame:
    """As :func:`yearly_close_stats` over text dates; unparsable dates form a NULL year."""
    return _yearly_stats(prices, _as_date(prices, date_col, fmt), F.col(price_col).cast("double"))


def _yearly_stats(df: DataFrame, day: F.Column, value: F.Column) -> DataFrame:
    return (df.select("asset", "quote", day.alias("_d"), value.alias("_v"))
            .groupBy("asset", "quote", F.year("_d").alias("year"))
            .agg(F.min("_d").alias("min_ts"), F.max("_d").alias("max_ts"),
                 F.min("_v").alias("min_close"), F.max("_v").alias("max_close")))


def high_water_mark(feed: DataFrame, asset: str, quote: str, date_col: str = "Timestamp",
                    default: str = HIGH_WATER_DEFAULT) -> DataFrame:
    """One row: the pair's latest date, or ``default`` if it has none."""
    return (feed.where((F.col("asset") == F.lit(asset)) & (F.col("quote") == F.lit(quote)))
            .agg(F.coalesce(F.max(_as_date(feed, date_col, PRIMARY_DATE_FORMAT)),
                            F.lit(default).cast("date")).alias("max_date")))


def high_water_date(feed: DataFrame, asset: str, quote: str, date_col: str = "Timestamp",
                    default: str = HIGH_WATER_DEFAULT):
    """:func:`high_water_mark` as a value (for a loader deciding where to resume).

    The aggregate always has exactly one row, so this brings one date to the
    driver.
    """
    return high_water_mark(feed, asset, quote, date_col, default).first()[0]
