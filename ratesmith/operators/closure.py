"""Rate closure: each rate plus identities and inverses, one row per key by priority.

For each source row (date, asset, quote, rate) four members are produced:

=========  =========================  ========
priority   member                     rate
=========  =========================  ========
1          (asset, quote)             rate
2          (asset, asset)             1.0
3          (quote, quote)             1.0
2          (quote, asset)             1 / rate (NULL when rate is 0 or NULL)
=========  =========================  ========

and per (date, asset, quote) the member with the lowest priority wins; among
equal priorities the lowest rate, NULL first.  A NULL source rate beats any
derived one.

Plan: one scan; the four members come from one generator, and the pick is one
hash aggregate.  The pick is the minimum of (priority, rate) with NULL rates
first; it is computed as fixed-width aggregates per priority level (lowest
level present, and per level whether a NULL rate occurs and the lowest rate),
so Spark keeps a codegen'd hash aggregate instead of falling back to sorting
on a struct minimum.  The aggregate combines map-side, so the many identical
identity rows of a busy currency collapse before the shuffle and no key can
overload a reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratesmith.functions.columns import safe_inverse

CLOSURE_COLUMNS = ("date", "asset", "quote", "rate")
PRIORITIES = (1, 2, 3)


def closure_members(rates_df: DataFrame) -> DataFrame:
    """The four prioritised members of every row: ``date, prio, asset, quote, rate``."""
    rate = F.col("rate").cast("double")

    def member(prio: int, asset: str, quote: str, value) -> F.Column:
        return F.struct(F.lit(prio).alias("prio"), F.col(asset).alias("asset"),
                        F.col(quote).alias("quote"), value.alias("rate"))

    members = F.array(
        member(1, "asset", "quote", rate),
        member(2, "asset", "asset", F.lit(1.0)),
        member(3, "quote", "quote", F.lit(1.0)),
        member(2, "quote", "asset", safe_inverse("rate")),
    )
    return rates_df.select("date", F.inline(members))


def rate_closure(rates_df: DataFrame) -> DataFrame:
    """``date, asset, quote, rate`` with one row per (date, asset, quote)."""
    prio, rate = F.col("prio"), F.col("rate")
    aggs = [F.min(prio).alias("best")]
    for p in PRIORITIES:
        aggs.append(F.bool_or((prio == p) & rate.isNull()).alias(f"null_{p}"))
        aggs.append(F.min(F.when(prio == p, rate)).alias(f"min_{p}"))
    picked = closure_members(rates_df).groupBy("date", "asset", "quote").agg(*aggs)
    choice = None
    for p in PRIORITIES:
        level = F.when(F.col(f"null_{p}"), F.lit(None).cast("double")).otherwise(F.col(f"min_{p}"))
        choice = (F.when(F.col("best") == p, level) if choice is None
                  else choice.when(F.col("best") == p, level))
    return picked.select("date", "asset", "quote", choice.alias("rate"))
