"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion into Spark's ``noop`` sink (every row is
produced, nothing is collected) once to warm up and then ``BENCH_RUNS`` times;
the median is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from ratesmith.operators import rates as R  # noqa: E402
from ratesmith.operators.closure import rate_closure  # noqa: E402
from ratesmith.operators.timeseries import fill_calendar  # noqa: E402
from ratesmith.plans import fixtures as FX  # noqa: E402
from ratesmith.plans.queries import QUERIES  # noqa: E402
from ratesmith.session import build_session, lineage_scope  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

# Headline queries: the registered ones that do the most work, plus the rate
# operators over ``fx_wide`` (thousands of pairs), whose rates grow with the data.
BENCH = {
    "rate_closure": QUERIES["rate_closure"],
    "rate_closure_wide": lambda s, d: rate_closure(FX.fx_wide(s, d)),
    "exchange_fill_wide": lambda s, d: fill_calendar(FX.fx_wide(s, d)),
    "latest_rates_wide": lambda s, d: R.latest_rates(FX.fx_wide(s, d)),
    "reconcile_feeds": QUERIES["reconcile_feeds"],
    "market_rates": QUERIES["market_rates"],
    "exchange_rates_filled": QUERIES["exchange_rates_filled"],
    "trades_union": QUERIES["trades_union"],
    "trade_valuation": QUERIES["trade_valuation"],
}


def run_once(spark, fn) -> float:
    with lineage_scope(spark):
        t0 = time.perf_counter()
        fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0


def main() -> None:
    extra = {"spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_dir:  # stage and task times for tools/stage_times.py
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(8, 2 * CPUS),
                          app_name="ratesmith-bench", extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(BENCH)
    times, counts, shuffles, errors = {}, {}, {}, {}
    for name in names:
        fn = BENCH[name]
        try:
            run_once(spark, fn)  # warm-up: JIT, file listing, parquet footers
            times[name] = round(statistics.median(run_once(spark, fn) for _ in range(RUNS)), 3)
            with lineage_scope(spark):
                df = fn(spark, SF_DIR)
                counts[name] = df.count()
            shuffles[name] = df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        except Exception as exc:  # report the others; the failure is visible in the line
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    out = {"metric": "total_median_sec", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": CPUS, "runs": RUNS,
           "rows": counts, "hash_shuffles": shuffles}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
