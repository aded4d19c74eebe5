"""The rate and trade computations over registered catalog tables.

For callers that work with the catalog (tables registered by
:func:`ratesmith.sources.files.register_rate_tables`): one method per
computation the original services offered.  Each returns a lazy DataFrame, except
that ``market_rates`` and ``trade_history`` first write small tables to the checkpoint
folder, which runs jobs.  Call these inside ``session.lineage_scope`` to have the tables
removed afterwards.

    svc = RateCatalog(spark)
    svc.register(currencylayer_root=..., crypto_root=...)
    svc.closed_rates().write...
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ratesmith.operators import rates as R
from ratesmith.operators import trades as TR
from ratesmith.plans import assembly
from ratesmith.sources import files as SF

CURRENCYLAYER = "currencylayer"
PRIMARY = "binance_currencies"
CRYPTO = "crypto_rates"
SECONDARY = "investing_currencies"


class RateCatalog:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    # -- tables
    def register(self, **roots: str) -> list[str]:
        """Register the given rate folders (see ``register_rate_tables``)."""
        return SF.register_rate_tables(self.spark, **roots)

    def refresh(self, *tables: str, drop_missing: bool = False) -> dict[str, SF.PartitionChange]:
        """Make partition folders added since registration visible; what changed, by table."""
        return {t: SF.refresh_partitions(self.spark, t, drop_missing)
                for t in tables or (CURRENCYLAYER, PRIMARY, CRYPTO, SECONDARY) if self.spark.catalog.tableExists(t)}

    def _t(self, name: str) -> DataFrame:
        return self.spark.table(name)

    # -- single feeds
    def yearly_close_stats(self) -> DataFrame:
        return R.yearly_close_stats(self._t(PRIMARY))

    def yearly_price_stats(self) -> DataFrame:
        return R.yearly_price_stats(self._t(SECONDARY))

    def dated_prices(self) -> DataFrame:
        return R.dated_prices(self._t(SECONDARY))

    def close_rates(self) -> DataFrame:
        return R.close_rates(self._t(CRYPTO))

    def high_water_mark(self, asset: str, quote: str) -> DataFrame:
        return R.high_water_mark(self._t(PRIMARY), asset, quote)

    # -- derived
    def reconciled(self) -> DataFrame:
        return R.reconcile_feeds(self._t(PRIMARY), self._t(SECONDARY))

    def market_rates(self, currencies: Iterable[str] = R.MARKET_CURRENCIES) -> DataFrame:
        return assembly.market_rates(self._t(PRIMARY), self._t(SECONDARY), currencies)

    def exchange_rates(self) -> DataFrame:
        return assembly.exchange_rates(self._t(CRYPTO))

    def closed_rates(self) -> DataFrame:
        return assembly.closed_rates(self._t(CURRENCYLAYER))

    @staticmethod
    def latest_rates(rates_df: DataFrame) -> DataFrame:
        return R.latest_rates(rates_df)

    def trade_history(self, binance_raw: DataFrame, symbols: DataFrame, exmo_raw: DataFrame,
                      rates_df: DataFrame | None = None,
                      currencies: Sequence[str] = TR.VALUATION_CURRENCIES) -> DataFrame:
        rates_df = self.exchange_rates() if rates_df is None else rates_df
        return assembly.trade_history(binance_raw, symbols, exmo_raw, rates_df, currencies)
