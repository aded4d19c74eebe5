"""The jobs: compositions of the operators.

* ``closed_rates``     - rate closure of one feed (the live job)
* ``exchange_rates``   - close rates of the multi-exchange feed, calendar-filled
* ``market_rates``     - two feeds reconciled, cross-rates, inverses, identities, filled
* ``trade_history``    - both exchanges' trades, valued in reference currencies
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratesmith.operators import rates as R
from ratesmith.operators import trades as TR
from ratesmith.operators.closure import rate_closure
from ratesmith.operators.timeseries import FILL_LIMIT, fill_calendar
from ratesmith.session import cut_lineage


def closed_rates(feed: DataFrame) -> DataFrame:
    """``date, asset, quote, rate``: each rate, its inverse and identities, one per key."""
    return rate_closure(feed)


def exchange_rates(crypto_rates: DataFrame, limit: int = FILL_LIMIT) -> DataFrame:
    """Close rates of every exchange plus the filled absent days, distinct."""
    return fill_calendar(R.close_rates(crypto_rates), limit)


def market_rates(primary: DataFrame, secondary: DataFrame,
                 currencies: Iterable[str] = R.MARKET_CURRENCIES,
                 common_base: Sequence[tuple[str, str, str]] = R.COMMON_BASE_TRIPLETS,
                 chains: Sequence[tuple[str, str, str]] = R.CHAIN_TRIPLETS,
                 inverse_pairs: Sequence[tuple[str, str]] = R.INVERSE_PAIRS,
                 limit: int = FILL_LIMIT, materialize: bool = True) -> DataFrame:
    """Rates of the listed currencies from two feeds, closed under the listed derivations.

    Order: reconcile -> keep listed currencies (applied to each feed before
    the join, which gives the same rows and prunes their folders) -> common-base cross-rates
    (read the base) -> chained cross-rates (read base + previous) -> inverses
    of the listed pairs (read all so far) -> identities -> calendar fill ->
    distinct.  No priority between a direct and a derived rate of one key.

    The original keeps every copy of a row through these steps; here copies are
    carried as a multiplicity column (``rates.WEIGHT``), which the distinct
    drops and the row-counted fill counts, so no step emits every pair of
    copies within a key.

    The cross-rates join tagged legs once per kind, and inverses and identities come from
    one generator, so the number of scans and joins does not depend on how many
    derivations are listed.  The branches would each recompute the reconciliation; with
    ``materialize`` the reconciled base (already cut down to the listed currencies) is
    written once to the checkpoint folder, which runs a job while the result is being
    built: pair filters then reach that table's scan, and a lost executor does not send
    Spark back to the feeds.
    """
    listed = list(currencies)
    base = R.reconcile_feeds(primary, secondary, currencies=listed, weights=True)
    if materialize:
        base = cut_lineage(base, "market-base")
    united = base.unionByName(R.cross_rate_common_base(base, common_base, weights=True))
    united = united.unionByName(R.cross_rate_chain(united, chains, weights=True))
    return fill_calendar(R.with_inverses_and_identities(united, inverse_pairs), limit)


def trade_history(binance_raw: DataFrame, symbols: DataFrame, exmo_raw: DataFrame,
                  rates_df: DataFrame,
                  currencies: Sequence[str] = TR.VALUATION_CURRENCIES,
                  missing_rate: float | None = 1.0, materialize_rates: bool = True) -> DataFrame:
    """Trades of both exchanges in one form, valued in ``currencies``.

    With ``materialize_rates`` the rates quoted in ``currencies`` are written
    once to the checkpoint folder, so the per-currency lookups read that small
    table (and its real size decides the broadcast) instead of each
    recomputing the rates' lineage.
    """
    trades = TR.union_trades(TR.normalise_trades(binance_raw, TR.BINANCE, symbols),
                             TR.normalise_trades(exmo_raw, TR.EXMO))
    if materialize_rates:
        rates_df = cut_lineage(rates_df.where(F.col("quote").isin(list(currencies)))
                               .select(*R.RATE_COLUMNS), "valuation-rates")
    return TR.value_trades(trades, rates_df, currencies, missing_rate)
