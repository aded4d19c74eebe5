"""End-to-end jobs: read the source files, compute, publish.

Each job publishes through a *sink*, a callable ``(DataFrame, table_name)``:
:func:`jdbc_sink` overwrites database tables (the original deployment),
:func:`file_sink` writes parquet folders.  Jobs return nothing and collect
nothing; every write runs on the executors.

    python -m ratesmith.plans.jobs closed-rates --currencylayer ROOT --out DIR
    python -m ratesmith.plans.jobs exchange-rates --crypto ROOT --out DIR [--update]
    python -m ratesmith.plans.jobs market-rates --ohlc ROOT --investing ROOT --out DIR
    python -m ratesmith.plans.jobs trade-history --binance GLOB --exmo GLOB \\
        --symbols PATH --rates DIR --out DIR [--currencies BTC,USDT]
    python -m ratesmith.plans.jobs exchange-trades --crypto ROOT --binance GLOB --exmo GLOB \\
        --symbols PATH --out DIR        (rates, latest rates and trade history from the same rates)

With ``--jdbc-url`` (plus ``--jdbc-driver``, ``--jdbc-user`` and
``--jdbc-password-env``, the name of the variable holding the password) the
results go to tables instead of ``--out``, through a staging table and one swap
(``--jdbc-direct``: straight into the table).
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratesmith.operators import rates as R
from ratesmith.operators import trades as TR
from ratesmith.plans import assembly
from ratesmith.plans import incremental as INC
from ratesmith.session import build_session, cut_lineage, lineage_scope
from ratesmith.sources import checked as CH
from ratesmith.sources import exchange_json as XJ
from ratesmith.sources import files as SF
from ratesmith.sources import publish as PB
from ratesmith.sources import sinks as SK

Sink = Callable[[DataFrame, str], None]

# Result table names (fixed values of the original deployment).
CLOSED_RATES_TABLE = "expenses.rates"
EXCHANGE_RATES_TABLE = "trades.rates"
LATEST_RATES_TABLE = "trades.max_rates"
TRADE_HISTORY_TABLE = "trades.trade_history"


PLAIN_READERS = {"currencylayer": SF.read_currencylayer, "ohlc": SF.read_ohlc,
                 "crypto": SF.read_crypto_rates, "investing": SF.read_investing}


def store_sink(store: PB.TableStore) -> Sink:
    """Staged publication (:mod:`ratesmith.sources.publish`): nothing repeated, old rows or new ones."""
    def write(df: DataFrame, table: str) -> None:
        PB.publish(df, table, store)
    return write


def jdbc_sink(url: str, properties: dict[str, str], staged: bool = True) -> Sink:
    """Tables behind a JDBC URL; without ``staged`` written directly, as the original did."""
    def write(df: DataFrame, table: str) -> None:
        if staged:
            PB.publish(df, table, PB.JdbcStore(df.sparkSession, url, properties))
        else:
            SK.write_jdbc(df, url, table, properties)
    return write


def file_sink(root: str, fmt: str = "parquet") -> Sink:
    def write(df: DataFrame, table: str) -> None:
        SK.write_files(df, f"{root.rstrip('/')}/{table}", fmt)
    return write


def _feed(spark: SparkSession, layout: str, root: str, rejects: Sink | None, table: str) -> DataFrame:
    """A rate feed; with a ``rejects`` sink its good rows only, the other lines going there under the table's name."""
    if rejects is None:
        return PLAIN_READERS[layout](spark, root)
    read = CH.read_checked(spark, layout, root)
    rejects(read.rejects, table)
    return read.good


def publish_closed_rates(spark: SparkSession, currencylayer_root: str, sink: Sink, rejects: Sink | None = None) -> None:
    """The live job: rate closure of the headerless feed."""
    feed = _feed(spark, "currencylayer", currencylayer_root, rejects, CLOSED_RATES_TABLE)
    sink(assembly.closed_rates(feed), CLOSED_RATES_TABLE)


def publish_exchange_rates(spark: SparkSession, crypto_root: str, sink: Sink, rejects: Sink | None = None) -> None:
    """Filled exchange rates and each pair's latest rate.

    The rates are written once to the checkpoint folder and both results are
    read from there, so the feed is scanned and filled once.
    """
    with lineage_scope(spark):
        _exchange_rates(spark, crypto_root, sink, rejects)


def _exchange_rates(spark: SparkSession, crypto_root: str, sink: Sink, rejects: Sink | None) -> DataFrame:
    feed = _feed(spark, "crypto", crypto_root, rejects, EXCHANGE_RATES_TABLE)
    rates = cut_lineage(assembly.exchange_rates(feed), "exchange-rates")
    sink(rates, EXCHANGE_RATES_TABLE)
    sink(R.latest_rates(rates), LATEST_RATES_TABLE)
    return rates


def update_closed_rates(spark: SparkSession, currencylayer_root: str, out: str, rejects: Sink | None = None,
                        redo_last: bool = False) -> INC.Run:
    """The live job, computing only the dates after those already under ``out`` (:mod:`ratesmith.plans.incremental`)."""
    feed = _feed(spark, "currencylayer", currencylayer_root, rejects, CLOSED_RATES_TABLE)
    return INC.update_closed_rates(spark, feed, f"{out.rstrip('/')}/{CLOSED_RATES_TABLE}", redo_last)


def update_exchange_rates(spark: SparkSession, crypto_root: str, out: str, rejects: Sink | None = None,
                          redo_last: bool = False) -> INC.Run:
    """Filled exchange rates beyond those already under ``out``; each pair's latest rate from all of them."""
    feed = _feed(spark, "crypto", crypto_root, rejects, EXCHANGE_RATES_TABLE)
    root = f"{out.rstrip('/')}/{EXCHANGE_RATES_TABLE}"
    run = INC.update_exchange_rates(spark, feed, root, redo_last)
    file_sink(out)(R.latest_rates(INC.published(spark, root).select(*R.RATE_COLUMNS)), LATEST_RATES_TABLE)
    return run


def publish_exchange_and_trades(spark: SparkSession, crypto_root: str, binance_glob: str, exmo_glob: str,
                                symbols_path: str, sink: Sink,
                                currencies: tuple[str, ...] = TR.VALUATION_CURRENCIES,
                                rejects: Sink | None = None) -> None:
    """Exchange rates, latest rates and the trade history valued with those same rates, in one run."""
    with lineage_scope(spark):
        rates = _exchange_rates(spark, crypto_root, sink, rejects)
        _trade_history(spark, binance_glob, exmo_glob, symbols_path, rates, sink, currencies)


def publish_market_rates(spark: SparkSession, ohlc_root: str, investing_root: str, sink: Sink,
                         table: str = CLOSED_RATES_TABLE,
                         currencies: tuple[str, ...] = R.MARKET_CURRENCIES,
                         rejects: Sink | None = None) -> None:
    """Rates of the listed currencies assembled from two feeds."""
    primary = _feed(spark, "ohlc", ohlc_root, rejects, f"{table}.ohlc")
    secondary = _feed(spark, "investing", investing_root, rejects, f"{table}.investing")
    with lineage_scope(spark):
        sink(assembly.market_rates(primary, secondary, currencies), table)


def publish_trade_history(spark: SparkSession, binance_glob: str, exmo_glob: str, symbols_path: str,
                          rates: DataFrame, sink: Sink,
                          currencies: tuple[str, ...] = TR.VALUATION_CURRENCIES) -> None:
    """Both exchanges' trades, valued in the reference currencies.

    The symbol list is parsed from exchange JSON that is far larger than the
    three columns kept; it is written once to the checkpoint folder so the
    planner sees its real size and broadcasts it, instead of shuffling every
    trade by pair.
    """
    with lineage_scope(spark):
        _trade_history(spark, binance_glob, exmo_glob, symbols_path, rates, sink, currencies)


def _trade_history(spark, binance_glob, exmo_glob, symbols_path, rates, sink, currencies) -> None:
    binance = CH.read_aligned_exports(spark, binance_glob, TR.BINANCE.columns)
    exmo = CH.read_aligned_exports(spark, exmo_glob, TR.EXMO.columns)
    symbols = cut_lineage(XJ.read_symbols(spark, symbols_path), "symbols")
    sink(assembly.trade_history(binance, symbols, exmo, rates, currencies), TRADE_HISTORY_TABLE)


# The arguments each job cannot do without.
NEEDED = {
    "closed-rates": ("currencylayer",),
    "exchange-rates": ("crypto",),
    "market-rates": ("ohlc", "investing"),
    "trade-history": ("binance", "exmo", "symbols", "rates"),
    "exchange-trades": ("crypto", "binance", "exmo", "symbols"),
}


def _sink_from_args(args) -> Sink:
    if args.jdbc_url:
        password = os.environ.get(args.jdbc_password_env, "") if args.jdbc_password_env else ""
        return jdbc_sink(args.jdbc_url, SK.jdbc_properties(args.jdbc_driver, args.jdbc_user, password), not args.jdbc_direct)
    if not args.out:
        raise SystemExit("give --out or --jdbc-url")
    return file_sink(args.out)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ratesmith.plans.jobs")
    p.add_argument("job", choices=list(NEEDED))
    p.add_argument("--currencylayer")
    p.add_argument("--crypto")
    p.add_argument("--ohlc")
    p.add_argument("--investing")
    p.add_argument("--binance")
    p.add_argument("--exmo")
    p.add_argument("--symbols")
    p.add_argument("--rates", help="parquet folder of exchange rates (asset, quote, date, rate)")
    p.add_argument("--currencies", help="comma list: market-rates keeps these currencies, "
                                        "trade-history values trades in these")
    p.add_argument("--out")
    p.add_argument("--update", action="store_true", help="closed-rates and exchange-rates: only the dates after those in --out")
    p.add_argument("--redo-last", action="store_true", help="with --update: compute the last run's dates again")
    p.add_argument("--rejects", help="folder for the lines of the rate files that do not parse (parquet, one table a feed)")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    p.add_argument("--jdbc-user", default="")
    p.add_argument("--jdbc-password-env")
    p.add_argument("--jdbc-direct", action="store_true", help="truncate and insert, without a staging table")
    p.add_argument("--master")
    args = p.parse_args(argv)

    missing = [f"--{a}" for a in NEEDED[args.job] if not getattr(args, a)]
    if missing:
        p.error(f"{args.job} needs {' '.join(missing)}")
    if not (args.out or args.jdbc_url):
        p.error("give --out or --jdbc-url")

    if args.update and (args.job not in ("closed-rates", "exchange-rates") or not args.out):
        p.error("--update needs --out and closed-rates or exchange-rates")

    spark = build_session(args.master)
    sink = _sink_from_args(args)
    rejects = file_sink(args.rejects) if args.rejects else None
    if args.update and args.job == "closed-rates":
        update_closed_rates(spark, args.currencylayer, args.out, rejects, args.redo_last)
    elif args.update:
        update_exchange_rates(spark, args.crypto, args.out, rejects, args.redo_last)
    elif args.job == "closed-rates":
        publish_closed_rates(spark, args.currencylayer, sink, rejects)
    elif args.job == "exchange-rates":
        publish_exchange_rates(spark, args.crypto, sink, rejects)
    elif args.job == "market-rates":
        cur = tuple(args.currencies.split(",")) if args.currencies else R.MARKET_CURRENCIES
        publish_market_rates(spark, args.ohlc, args.investing, sink, currencies=cur, rejects=rejects)
    elif args.job == "exchange-trades":
        cur = tuple(args.currencies.split(",")) if args.currencies else TR.VALUATION_CURRENCIES
        publish_exchange_and_trades(spark, args.crypto, args.binance, args.exmo, args.symbols, sink, cur, rejects)
    else:
        cur = tuple(args.currencies.split(",")) if args.currencies else TR.VALUATION_CURRENCIES
        publish_trade_history(spark, args.binance, args.exmo, args.symbols,
                              spark.read.parquet(args.rates), sink, currencies=cur)


if __name__ == "__main__":
    main()
