"""Components of verified links among items that share list keys.

Given entries (item, list key), every two items of a list may be linked; which of them are
is told by a verification.  All pairs of a list are never made:

1. Every item is verified against the first items of its lists in a few orders that all lists
   share, so that most of a large group hangs on the same few hubs.
2. The items of a list (or of lists that are connected by common items) form a family.  Only
   items of *different* components of a family can still change the result, so only those
   are verified: a small family at once, a larger one block against block.  Blocks lie within one
   component where it is large enough, and two blocks of one component are not compared.  A
   task holds two blocks, or small families one after the other.

The result is the same as that of verifying all pairs of every family.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm.graph import connected_components
from ratesmith.session import cut_lineage

HUBS = 3
BLOCK = 256


def _pair_task(verify: Callable):
    def run(batches):
        for batch in batches:
            ok = verify(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _family_task(verify: Callable, together: bool = False):
    """Verifies the families of a task: one at a time, or as many ``together`` as make a block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("family")
        family = table.column("family").to_numpy()
        comp, side = table.column("component").to_pylist(), table.column("side").to_numpy()
        items = table.column("item").to_pylist()
        cut = [*np.flatnonzero(np.concatenate([[True], family[1:] != family[:-1]])).tolist(), len(family)]
        joined = set()
        for i, j in _runs(cut, BLOCK if together else 0):
            number = np.unique(np.array(comp[i:j], dtype=object), return_inverse=True)[1]
            asked = comparable(number, side[i:j]) & (family[i:j, None] == family[None, i:j])
            if asked.any():
                link = verify(items[i:j], number, asked) & asked
                joined |= {tuple(sorted((comp[i + a], comp[i + b]))) for a, b in zip(*np.nonzero(link))}
        pairs = sorted(joined)
        return pa.table([pa.array([p[k] for p in pairs], pa.binary()) for k in range(2)], names=["a", "b"])

    return run


def _runs(cut: list[int], most: int):
    """(first, end) of runs of whole families of up to ``most`` rows, or of one family."""
    first = 0
    for k in range(1, len(cut)):
        if k + 1 == len(cut) or cut[k + 1] - cut[first] > most:
            yield cut[first], cut[k]
            first = k


def comparable(component: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Pairs a task is asked about: of different components, and across the blocks if there are two."""
    different = component[:, None] != component[None, :]
    if (side == 1).any():
        return different & (side[:, None] == 0) & (side[None, :] == 1)
    return np.triu(different)


def _stars(entries: DataFrame) -> DataFrame:
    rank = [F.xxhash64("sig", F.lit(k)) for k in range(HUBS)]
    hubs = entries.groupBy("x", "band").agg(*[F.min(F.struct(rank[k].alias("r"), "sig")).alias(f"hub{k}") for k in range(HUBS)])
    return (entries.join(hubs, ["x", "band"])
            .select("sig", F.explode(F.array(*[F.col(f"hub{k}.sig") for k in range(HUBS)])).alias("hub"))
            .where("sig <> hub").select(F.least("sig", "hub").alias("a"), F.greatest("sig", "hub").alias("b")).distinct())


def _families(entries: DataFrame, by_list: bool) -> DataFrame:
    """(sig, family): the lists of an item, or the one family of all lists it is connected to."""
    if by_list:
        return entries.select("sig", F.col("x").alias("family"))
    hubs = entries.groupBy("x").agg(F.min("sig").alias("hub"))
    lists = connected_components(entries.join(hubs, "x").select("sig", "hub"))
    return lists.select(F.col("node").alias("sig"), F.xxhash64("component").alias("family"))


def _by_cheaper_lists(member: DataFrame, entries: DataFrame) -> DataFrame:
    """``member`` with the families of connected lists split into their lists where these take fewer rows to compare.

    An item goes to a task with every block of its family, or of its list.
    """
    sent = lambda n: F.sum(n * F.ceil(n / BLOCK))
    large = member.groupBy("family").agg(F.count("*").alias("all"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    large = large.where((F.col("all") > BLOCK) & (F.col("lo") != F.col("hi"))).select("family", "all")
    large = member.join(large, "family")
    lists = entries.join(large.select("sig", "family", "component"), "sig")
    by_list = lists.groupBy("family", "x").agg(F.count("*").alias("k")).groupBy("family").agg(sent(F.col("k")).alias("lists"))
    whole = large.groupBy("family").agg(F.sum(F.ceil(F.col("all") / BLOCK)).alias("blocks"))
    split = cut_lineage(by_list.join(whole, "family").where("lists < blocks").select("family"), "split-families")
    listed = lists.join(split, "family").select("sig", F.xxhash64("family", "x").alias("family"), "component")
    return member.join(split, "family", "left_anti").select("sig", "family", "component").union(listed)


def _cross_links(entries: DataFrame, items: DataFrame, linked: DataFrame, verify_block: Callable, by_list: bool) -> DataFrame:
    """Links between different components of one family, as pairs of components."""
    chunks = 4 * int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    member = (_families(entries, by_list).join(linked.select(F.col("node").alias("sig"), "component"), "sig", "left")
              .withColumn("component", F.coalesce("component", "sig")))
    member = cut_lineage(member, "families")
    if not by_list:
        member = cut_lineage(_by_cheaper_lists(member, entries), "families")
    by_comp = member.groupBy("family", "component").agg(F.count("*").alias("k"))
    own = F.col("k") >= BLOCK // 2
    mixed = by_comp.groupBy("family").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.sum("k").alias("all"),
                                          F.sum(F.when(own, 0).otherwise(F.col("k"))).alias("pool"))
    mixed = mixed.where("lo <> hi").select("family", "all", "pool")
    open_ = cut_lineage(member.join(mixed, "family"), "open-families")
    small = open_.where(F.col("all") <= BLOCK).select(
        F.pmod(F.xxhash64("family"), F.lit(chunks)).alias("task"), "family", F.lit(0).alias("side"), "sig", "component")
    blocked = (open_.where(F.col("all") > BLOCK).join(by_comp, ["family", "component"])
               .withColumn("pure", F.when(own, F.col("component")))
               .withColumn("block", F.pmod(F.xxhash64("sig"), F.ceil(F.when(own, F.col("k")).otherwise(F.col("pool")) / BLOCK)))
               .withColumn("block_id", F.xxhash64("family", F.coalesce("pure", F.lit(b"")), "block"))
               .select("sig", "component", "family", "pure", "block_id"))
    blocks = blocked.select("family", "block_id", "pure").distinct()
    other = blocks.select("family", F.col("block_id").alias("other_id"), F.col("pure").alias("other_pure"))
    pairs = (blocks.join(other, "family").where("block_id <= other_id")
             .where("NOT coalesce(pure = other_pure, false)")
             .select("family", "block_id", "other_id", F.xxhash64("family", "block_id", "other_id").alias("task")))
    sides = pairs.select("family", "block_id", "task", F.lit(0).alias("side")).union(
        pairs.where("block_id <> other_id").select("family", F.col("other_id").alias("block_id"), "task", F.lit(1).alias("side")))
    large = blocked.join(sides, ["family", "block_id"]).select("task", "family", "side", "sig", "component")
    rows = small.withColumn("large", F.lit(False)).union(large.withColumn("large", F.lit(True))).join(items, "sig")
    # the work grows with the pairs, not the bytes, so adaptive execution must not join these partitions
    return rows.select("large", "task", "family", "side", "component", "item").repartition(chunks // 4, "large", "task").groupBy(
        "large", "task").applyInArrow(_family_task(verify_block, by_list), "a binary, b binary")


def linked_components(entries: DataFrame, items: DataFrame, verify_pairs: Callable, verify_block: Callable,
                      known: DataFrame | None = None, by_list: bool = False) -> DataFrame:
    """(node, component) of all items linked to another, by verified or ``known`` links.

    ``entries``: sig binary, x long (list key), band (items of different bands have no common hub).
    ``items``: sig, item (what the verification reads).  ``verify_pairs(left, right)`` gives a truth
    value per pair; ``verify_block(items, component, asked)`` a matrix of the links among the
    ``asked`` pairs (it may leave out links that others imply).  ``by_list`` compares items of one
    list only, which suits short lists and small items; else lists that share items are compared as one.
    """
    pairs = _stars(entries)
    verified = (pairs.join(items.select(F.col("sig").alias("a"), F.col("item").alias("left")), "a")
                .join(items.select(F.col("sig").alias("b"), F.col("item").alias("right")), "b")
                .select("a", "b", "left", "right").mapInArrow(_pair_task(verify_pairs), "a binary, b binary"))
    links = cut_lineage(verified if known is None else verified.union(known), "links")
    linked = cut_lineage(connected_components(links), "linked")
    more = cut_lineage(_cross_links(entries.select("sig", "x"), items, linked, verify_block, by_list), "cross-links")
    roots = connected_components(more)
    root = roots.select(F.col("node").alias("component"), F.col("component").alias("root"))
    label = linked.join(root, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return label.unionByName(roots).dropDuplicates(["node"])
