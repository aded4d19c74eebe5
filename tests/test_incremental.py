"""Runs after a high-water mark: all increments together are the full run."""

import datetime as dt
import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratesmith.operators import rates as R
from ratesmith.plans import assembly, jobs
from ratesmith.plans import fixtures as FX
from ratesmith.plans import incremental as I

SF = "/root/testdata/sf0.001"
D0 = dt.date(2024, 1, 1)
COLS = ["asset", "quote", "date", "rate"]


def as_rows(df):
    return Counter(tuple(r) for r in df.select(*COLS).collect())


def feed_of(spark, rows):
    return spark.createDataFrame(rows, "asset string, quote string, date date, rate double")


def random_rows(seed, days=40):
    """Pairs that lag behind, pause, start late and repeat rows; NULL rates, NULL currencies, rows without a date."""
    rnd, rows = random.Random(seed), []
    for asset, quote, density in (("A", "USD", 0.9), ("B", "USD", 0.3), ("C", "USD", 0.08), (None, "USD", 0.3), ("D", None, 0.2), (None, None, 0.2)):
        start = rnd.choice([0, 0, days // 2])
        for k in range(start, days):
            if rnd.random() < density:
                for _ in range(rnd.choice([1, 1, 1, 2, 5])):
                    rows.append((asset, quote, D0 + dt.timedelta(days=k), rnd.choice([None, 0.0, 1.5, 2.5, 2.5])))
    return rows + [("A", "USD", None, 1.0), ("A", "USD", None, 1.0), (None, "USD", None, None)]


def upto(rows, day):
    return [r for r in rows if r[2] is None or r[2] <= day]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_increments_are_the_full_run(spark, scratch, seed):
    rows = random_rows(seed)
    cuts = [D0 + dt.timedelta(days=k) for k in sorted(random.Random(seed).sample(range(5, 39), 3))] + [D0 + dt.timedelta(days=99)]
    for cut in cuts:
        feed = feed_of(spark, upto(rows, cut))
        filled = I.update(spark, feed, f"{scratch}/ex", I.exchange_rates_after)
        I.update_closed_rates(spark, feed, f"{scratch}/cl")
        assert as_rows(I.published(spark, f"{scratch}/ex")) == as_rows(I.fill_calendar(feed))
        assert as_rows(I.published(spark, f"{scratch}/cl")) == as_rows(assembly.closed_rates(feed))
    runs = {r[0] for r in I.published(spark, f"{scratch}/ex").select("after").distinct().collect()}
    assert I.FIRST in runs and I.UNDATED in runs and len(runs) >= 3 and filled.mark is not None


def test_a_run_repeated_changes_nothing(spark, scratch):
    rows = random_rows(4)
    root, half = f"{scratch}/ex", D0 + dt.timedelta(days=20)
    for cut in (half, D0 + dt.timedelta(days=99)):
        I.update(spark, feed_of(spark, upto(rows, cut)), root, I.exchange_rates_after)
    want = as_rows(I.published(spark, root))
    assert I.update(spark, feed_of(spark, rows), root, I.exchange_rates_after).rows == 0  # nothing newer
    assert as_rows(I.published(spark, root)) == want
    again = I.update(spark, feed_of(spark, rows), root, I.exchange_rates_after, redo_last=True)
    assert again.rows > 0 and as_rows(I.published(spark, root)) == want
    # the last run's days get more rows, which only a redo picks up
    late = [("B", "USD", half + dt.timedelta(days=2), 9.0), ("E", "USD", half + dt.timedelta(days=3), 9.0)]
    I.update(spark, feed_of(spark, rows + late), root, I.exchange_rates_after, redo_last=True)
    assert as_rows(I.published(spark, root)) == as_rows(I.fill_calendar(feed_of(spark, rows + late)))
    # and a redo without any newer row takes the last run's rows away
    I.update(spark, feed_of(spark, upto(rows, half)), root, I.exchange_rates_after, redo_last=True)
    assert as_rows(I.published(spark, root)) == as_rows(I.fill_calendar(feed_of(spark, upto(rows, half))))


def test_earlier_runs_are_not_written_again(spark, scratch):
    rows = random_rows(5)
    root = f"{scratch}/cl"
    I.update_closed_rates(spark, feed_of(spark, upto(rows, D0 + dt.timedelta(days=20))), root)
    files = lambda: {n: os.path.getmtime(os.path.join(d, n)) for d, _, names in os.walk(root) if "after=0001" in d for n in names}
    before = files()
    I.update_closed_rates(spark, feed_of(spark, rows), root)
    assert before and files() == before


def test_the_mark_reaches_the_scan(spark, scratch):
    feed_of(spark, random_rows(6)).write.parquet(f"{scratch}/feed")
    feed = spark.read.parquet(f"{scratch}/feed")
    plan = I.closed_rates_after(feed, D0, feed)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(date,2024-01-01)" in plan
    prior = I.fill_calendar(feed.where(F.col("date") <= D0 + dt.timedelta(days=20)))
    plan = I.exchange_rates_after(feed, D0 + dt.timedelta(days=20), prior)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(date,") >= 2


def test_empty_feeds(spark, scratch):
    empty = feed_of(spark, [])
    assert I.update_closed_rates(spark, empty, f"{scratch}/cl") == I.Run(None, 0)
    assert I.published(spark, f"{scratch}/cl").count() == 0
    assert I.update_closed_rates(spark, feed_of(spark, [("A", "B", D0, 2.0)]), f"{scratch}/cl") == I.Run(None, 4)
    assert I.update_closed_rates(spark, empty, f"{scratch}/cl") == I.Run(D0, 0)


def test_jobs_update_their_output(spark, scratch):
    o = FX.ohlc(spark, SF).withColumn("exchange", F.lit("kraken"))
    half = o.agg(F.expr("percentile(datediff(Timestamp, DATE '1970-01-01'), 0.5)")).first()[0]
    half = dt.date(1970, 1, 1) + dt.timedelta(days=int(half))
    for part, mode in ((o.where(F.col("Timestamp") <= half), "overwrite"), (o.where(F.col("Timestamp") > half), "append")):
        part.write.mode(mode).partitionBy("exchange", "asset", "quote").option("header", "true").csv(f"{scratch}/currency")
        jobs.main(["exchange-rates", "--crypto", f"{scratch}/currency", "--out", f"{scratch}/out", "--update"])
    got = I.published(spark, f"{scratch}/out/{jobs.EXCHANGE_RATES_TABLE}")
    assert as_rows(got) == as_rows(assembly.exchange_rates(o)) and got.select("after").distinct().count() == 2
    latest = spark.read.parquet(f"{scratch}/out/{jobs.LATEST_RATES_TABLE}")
    assert as_rows(latest) == as_rows(R.latest_rates(assembly.exchange_rates(o)))


# ---- who removes the tables of lineage cuts ------------------------------------------------

def test_a_list_of_queries_leaves_no_table_behind(scratch):
    """In a process of its own, as the tables go when the session's JVM ends."""
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
import os
from ratesmith.session import build_session
import __spark_entry__ as E
spark = build_session("local[2]", 2, extra={{"spark.checkpoint.dir": "file://{scratch}/shared"}})
for name in ("market_rates", "trade_valuation"):
    assert E.queries()[name](spark, {SF!r}).count() > 0
print("TABLES", sum(len(names) for _, names, _ in os.walk({scratch!r} + "/shared/tables")), flush=True)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "TABLES" in done.stdout and int(done.stdout.split("TABLES")[1]) > 2, done.stderr[-2000:]
    left = [n for _, names, files in os.walk(f"{scratch}/shared/tables") for n in names + files]
    assert left == []


def test_sweep_and_release(spark, scratch, monkeypatch):
    from ratesmith import session as S

    # a folder of its own: the configured one may hold other sessions' tables
    monkeypatch.setattr(S, "_tables_root", lambda spark: f"file:{scratch}/tables")
    df = S.cut_lineage(spark.range(3), "probe")
    assert df.count() == 3
    own = S.lineage_folder(spark).removeprefix("file:")
    root = os.path.dirname(own)
    old = {}
    for name in ("session-app-1", "job-2", "somebody-else", "session-app-3"):
        os.makedirs(f"{root}/{name}/stage-1")
        stamp = 1_600_000_000 if name != "session-app-3" else None
        for path in (f"{root}/{name}/stage-1", f"{root}/{name}"):
            if stamp:
                os.utime(path, (stamp, stamp))
        old[name] = stamp
    gone = {os.path.basename(p) for p in S.sweep_lineage(spark, 24)}
    assert {"session-app-1", "job-2"} <= gone and not gone & {"somebody-else", "session-app-3", os.path.basename(own)}
    assert df.count() == 3  # this session's tables stay
    with S.lineage_scope(spark) as scope:
        assert S.lineage_folder(spark) == scope
    assert df.count() == 3 and os.path.isdir(own)
    S.release_lineage(spark)
    assert not os.path.exists(own)
