"""The search for links among items that share list keys, and what it sends and leaves behind."""

import os
import time

from pyspark.sql import functions as F

from ratesmith.llm import links
from ratesmith.session import cut_lineage


def _entries(spark, lists):
    rows = [(f"{i:05d}".encode(), x) for x, members in enumerate(lists) for i in members]
    entries = spark.createDataFrame(rows, "sig binary, x long").withColumn("band", F.lit(0))
    items = entries.select("sig").distinct().select("sig", F.col("sig").cast("string").alias("item"))
    return entries, items


def _search(spark, lists, scratch, by_list, together):
    """Components where hubs find nothing and a block links ``together(a, b)``; (components, calls, pairs asked)."""
    def block(items, component, asked):
        with open(f"{scratch}/{os.getpid()}", "a") as f:
            f.write(f"{asked.sum()}\n")
        link = asked.copy()
        for a, b in zip(*asked.nonzero()):
            link[a, b] = together(*sorted((int(items[a]), int(items[b]))))
        return link

    entries, items = _entries(spark, lists)
    found = links.linked_components(entries, items, lambda left, right: [False] * len(left), block, by_list=by_list)
    label = {int(r["node"]): int(r["component"]) for r in found.collect()}
    asked = [int(x) for p in os.listdir(scratch) for x in open(f"{scratch}/{p}")]
    return label, len(asked), sum(asked)


def test_short_lists_connected_by_chance_are_not_compared_as_one(spark, scratch):
    n = 900
    label, _, asked = _search(spark, [(i, i + 1) for i in range(n)], scratch, False, lambda a, b: b == a + 1 and a % 10 == 0)
    assert label == {i + k: i for i in range(0, n, 10) for k in (0, 1)}
    assert asked == n  # the neighbours; all pairs of the chain are 405,450


def test_one_long_list_beside_short_ones_keeps_its_family(spark, scratch):
    n = 600
    lists = [range(n), range(0, n, 2), range(0, n, 3), range(1, n, 2)]
    label, _, asked = _search(spark, lists, scratch, False, lambda a, b: b == a + 300)
    assert label == {i + k: i for i in range(300) for k in (0, 300)}
    assert asked == n * (n - 1) // 2


def test_short_lists_are_verified_many_at_a_time(spark, scratch):
    n = 1500
    label, calls, asked = _search(spark, [(3 * i, 3 * i + 1, 3 * i + 2) for i in range(n)], scratch, True, lambda a, b: a % 9 == 0 and b == a + 2)
    assert label == {i + k: i for i in range(0, 3 * n, 9) for k in (0, 2)}
    assert asked == 3 * n  # no pairs across lists
    assert calls < n / 10


def test_runs_hold_whole_families():
    assert list(links._runs([0, 2, 4, 9, 10], 4)) == [(0, 4), (4, 9), (9, 10)]
    assert list(links._runs([0, 2, 4, 9, 10], 0)) == [(0, 2), (2, 4), (4, 9), (9, 10)]
    assert list(links._runs([0, 7], 4)) == [(0, 7)]


def _shuffle_files(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, names in os.walk(str(d)) for f in names if f.startswith("shuffle_")}


def test_a_cut_leaves_no_shuffle_files(spark):
    keyed = spark.range(1000).select((F.col("id") % 7).alias("k"))
    before = _shuffle_files(spark)
    table = cut_lineage(keyed.groupBy("k").count().join(keyed.repartition(5, "k"), "k"), "dropped")
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert table.count() == 1000
    before = _shuffle_files(spark)
    result = keyed.groupBy("k").count()
    assert result.collect() and _shuffle_files(spark) - before  # of other results they stay
    assert len(result.collect()) == 7
