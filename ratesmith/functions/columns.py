"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation.  Spark 4 runs in ANSI mode: division by zero, bad casts, bad
date text and out-of-range array indexes raise, where the lenient mode the
jobs were written for returned NULL.  The ``try_*`` forms below keep the NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stablecoin folded into its fiat currency when two feeds meet.
STABLECOIN = "USDT"
STABLECOIN_FIAT = "USD"


def col_or_name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_stablecoin(c: Column | str) -> Column:
    """``USDT`` -> ``USD``, every other value (NULL included) unchanged."""
    c = col_or_name(c)
    return F.when(c == F.lit(STABLECOIN), F.lit(STABLECOIN_FIAT)).otherwise(c)


def safe_inverse(rate: Column | str) -> Column:
    """``1 / rate`` as DOUBLE; NULL for a zero or NULL rate."""
    return F.try_divide(F.lit(1.0), col_or_name(rate).cast("double"))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    return F.try_divide(col_or_name(numerator).cast("double"),
                        col_or_name(denominator).cast("double"))


def parse_date(text: Column | str, fmt: str) -> Column:
    """Text -> DATE with ``fmt``; NULL when the text does not parse.

    A time part in the format is parsed and dropped.
    """
    return F.try_to_date(col_or_name(text), fmt)


def strip_to_number(text: Column | str) -> Column:
    """Keep digits and dots, then read as DOUBLE (NULL if nothing numeric is left).

    Unit suffixes (``0.5BTC``), thousands separators and minus signs are removed;
    digits that belong to an asset name stay (``12.51INCH`` -> ``12.51``).
    """
    return F.regexp_replace(col_or_name(text), r"[^0-9.]", "").try_cast("double")


def to_double(text: Column | str) -> Column:
    return col_or_name(text).try_cast("double")


def split_part(text: Column | str, sep: str, index: int) -> Column:
    """0-based element of ``split(text, sep)``; NULL when it does not exist."""
    return F.get(F.split(col_or_name(text), sep), F.lit(index))


def either_side_in(currencies: Iterable[str], asset: str = "asset", quote: str = "quote") -> Column:
    """``asset IN (..) OR quote IN (..)``."""
    values = list(currencies)
    return F.col(asset).isin(values) | F.col(quote).isin(values)


def pair_in(pairs: Sequence[tuple[str, str]], asset: str = "asset", quote: str = "quote") -> Column:
    """``(asset, quote)`` equals one of ``pairs``.

    Written as a disjunction of equalities so that it reaches the scan as a
    pushed filter and prunes ``asset=/quote=`` partition folders.
    """
    cond = F.lit(False)
    for a, q in pairs:
        cond = cond | ((F.col(asset) == F.lit(a)) & (F.col(quote) == F.lit(q)))
    return cond


# Rows generated at a time when a row is repeated.
REPEAT_CHUNK = 10_000


def repeat_rows(df: DataFrame, count_col: str, chunk: int = REPEAT_CHUNK) -> DataFrame:
    """Each row ``count_col`` times (a 64-bit count), without the count.

    Two generators: one row per chunk, then at most ``chunk`` copies each, so no array
    holds all copies of a row.
    """
    n = F.col(count_col).cast("long")
    out = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / F.lit(chunk)).cast("long"))))
    here = F.least(F.lit(chunk).cast("long"), n - F.col("_chunk") * F.lit(chunk))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), here))).drop("_chunk", "_copy", count_col)
