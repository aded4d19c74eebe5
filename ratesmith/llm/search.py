"""Ranked lexical search of many queries at once, with shared partial sums (operator 12).

Scores are sums over a query's terms (repeats included) of integer term scores that depend only on the
term and the document.  Queries share terms, and sets of terms: from the queries' term lists a graph
of sums is mined, in which the pair of operands that most queries have in common becomes one
operand of its own, again and again, until no pair is left in two queries.  A node of the graph
stands for a set of terms; its partial score is computed once per document and used by
every query that contains the set.

1. Documents are read once; of each, the number of terms and the counts of the queries' terms
   are written as a compact table.  Document frequencies, N and L are aggregated from it.
2. Tasks read that table in slices of documents, score the terms, and evaluate the graph level by level
   over an array of nodes by documents.  A task keeps the ``k`` best documents of each query, so
   that ``k`` rows a query and task are shuffled, however many documents score.
3. The best ``k`` of all are picked in two steps, first within 64 salts.

Queries are dealt into blocks of at most ``BLOCK_TERMS`` terms (a longer query has a block of its own); a
block's distinct terms and graph are what the driver holds and broadcasts.  More queries mean more
blocks, one after the other, not more memory.

Defined cases: null and empty texts and texts without terms have no terms, are not counted in N and rank
nowhere; a query without terms gives no rows; repeated query rows give their result each (equal
queries are evaluated once); repeated documents rank each; documents of equal score are ordered by
``doc_id``, a null one last; a document with a score of 0 does not rank; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import collections
import hashlib
import heapq
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded
from ratesmith.session import cut_lineage

TOP = 20
BLOCK_TERMS = 20_000
#: Operands among which shared pairs are sought; a longer query is mined piece by piece.
PIECE = 64
#: Cells (nodes x documents) of the array that a task evaluates the graph over.
CELLS = 4 << 20
SALTS = 64
# Fixed values of the score: term weight scale, score scale, saturation (in thousandths), share of the length norm in percent.
WEIGHT_SCALE, SCORE_SCALE, TF_SCALE, SATURATION, LENGTH_PERCENT = 1000, 1_000_000_000, 1000, 12, 25


# ---- the graph of shared sums ----------------------------------------------------------------

def mine_shared_sums(queries: list[collections.Counter], n_terms: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Sums shared by the queries, as a graph: (pairs of operands, root of each query).

    Queries are counted terms 0..n_terms-1, none of them empty.  Node n_terms + i is the sum of the
    operands ``pairs[i]``, which come before it; a query's root is the node (or term) of its whole sum.
    A term that a query has c times is c operands (its first, second, ... use), so that sums of
    repeated terms are shared as well.  Pairs are sought within pieces of ``PIECE`` operands of a query.
    """
    use_number: dict[tuple[int, int], int] = {}
    pieces: list[set[int]] = []
    pieces_of = []
    for q in queries:
        own = [t if use == 0 else use_number.setdefault((t, use), -1 - len(use_number)) for t, times in sorted(q.items()) for use in range(times)]
        pieces_of.append(range(len(pieces), len(pieces) + -(-len(own) // PIECE)))
        pieces += [set(own[i:i + PIECE]) for i in range(0, len(own), PIECE)]
    term_of = {-1 - i: t for i, (t, _) in enumerate(use_number)}
    holders: dict[tuple[int, int], list[int]] = collections.defaultdict(list)
    for number, own in enumerate(pieces):
        for pair in itertools.combinations(sorted(own), 2):
            holders[pair].append(number)
    holders = {pair: who for pair, who in holders.items() if len(who) > 1}
    heap = [(-len(who), pair) for pair, who in holders.items()]
    heapq.heapify(heap)
    pairs: list[tuple[int, int]] = []

    def join(a: int, b: int) -> int:
        pairs.append((term_of.get(a, a), term_of.get(b, b)))
        return n_terms + len(pairs) - 1

    while heap:
        times, pair = heapq.heappop(heap)
        a, b = pair
        who = [p for p in holders[pair] if a in pieces[p] and b in pieces[p]]
        if len(who) < -times:  # some of its holders have used an operand elsewhere since it was queued
            holders[pair] = who
            if len(who) > 1:
                heapq.heappush(heap, (-len(who), pair))
            continue
        del holders[pair]
        new = join(a, b)
        fresh = collections.defaultdict(list)
        for p in who:
            pieces[p] -= {a, b}
            for x in pieces[p]:
                fresh[x, new].append(p)
            pieces[p].add(new)
        for pair, who in fresh.items():
            if len(who) > 1:
                holders[pair] = who
                heapq.heappush(heap, (-len(who), pair))
    roots = []
    for own in pieces_of:  # what no other query shares is summed neighbour by neighbour, which keeps the graph flat
        level = [x for p in own for x in sorted(pieces[p])]
        while len(level) > 1:
            level = [join(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        roots.append(term_of.get(level[0], level[0]))
    return pairs, roots


def levels(n_terms: int, pairs: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(nodes, left operands, right operands) by depth: operands lie in earlier levels."""
    depth = [0] * n_terms
    by_depth = collections.defaultdict(list)
    for i, (a, b) in enumerate(pairs):
        depth.append(1 + max(depth[a], depth[b]))
        by_depth[depth[-1]].append((n_terms + i, a, b))
    return [tuple(np.array(column) for column in zip(*by_depth[d])) for d in sorted(by_depth)]


# ---- terms -----------------------------------------------------------------------------------

def query_terms(text: str | None) -> list[str]:
    """The terms of one query, in order."""
    data = K.lower_ascii(np.frombuffer((text or "").encode(), np.uint8))
    start, end, _ = K.runs(K.ALNUM_WORD[data], np.array([0, len(data)]))
    return [data[s:e].tobytes().decode() for s, e in zip(start, end)]


class TermTable:
    """Finds the words of a text buffer that are in a list of terms, and which; every hit is compared byte by byte."""

    def __init__(self, terms: list[str], seed: int = 0):
        raw = [t.encode() for t in terms]
        size = np.array([len(t) for t in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        end = np.cumsum(size)
        self.values, self.rolling = K.byte_values(seed), K.Rolling()
        key = self._keys(data, end - size, end)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]
        self.by_size = {}
        slot = np.zeros(len(raw), np.int64)
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            slot[at] = np.arange(len(at))
            self.by_size[int(n)] = data[(end - size)[at][:, None] + np.arange(n)]
        self.slot = slot

    def _keys(self, data, start, end):
        return K.mix(self.rolling.load(self.values[data]).spans(start, end) ^ (end - start).astype(np.uint64))

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the word, number of its term) of all words that are terms.  Terms have different keys."""
        if not len(self.keys) or not len(start):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        key = self._keys(data, start, end)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        word = np.flatnonzero(self.keys[at] == key)
        term = self.order[at[word]]
        size = (end - start)[word]
        good = np.zeros(len(word), bool)
        for n in np.unique(size):
            same = np.flatnonzero(size == n)
            table = self.by_size.get(int(n))
            if table is None:
                continue
            cells = np.arange(n)
            for piece in np.array_split(same, 1 + len(same) * int(n) // K.SLICE_BYTES):
                known = table[np.minimum(self.slot[term[piece]], len(table) - 1)]
                good[piece] = (data[start[word[piece]][:, None] + cells] == known).all(axis=1)
        return word[good], term[good]


def _seed(terms: list[str]) -> int:
    """A seed that gives every term a key of its own."""
    for seed in itertools.count():
        keys = TermTable(terms, seed).keys
        if len(keys) < 2 or (keys[1:] != keys[:-1]).all():
            return seed


def _index(documents: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, times): of each document its number of terms, and the listed ones it holds, as int32 arrays."""
    shared = documents.sparkSession.sparkContext.broadcast((terms, _seed(terms)))
    names = ["doc_id", "n", "terms", "times"]

    def run(batches):
        listed, seed = shared.value
        table = TermTable(listed, seed)
        for batch in batches:
            data, offsets = K.text_buffer(batch.column(1))
            total, found, times = [], [], []
            for a, b in K.slices(offsets):
                d = K.lower_ascii(data[offsets[a]: offsets[b]])
                start, end, row = K.runs(K.ALNUM_WORD[d], offsets[a: b + 1] - offsets[a])
                total.append(K.counts(row, b - a))
                word, term = table.find(d, start, end)
                pair, n = np.unique(row[word] * len(listed) + term, return_counts=True)
                cut = np.searchsorted(pair, np.arange(b - a + 1) * len(listed))
                terms_of, n = (pair % len(listed)).astype(np.int32), n.astype(np.int32)
                found += [terms_of[i:j].tobytes() for i, j in zip(cut, cut[1:])]
                times += [n[i:j].tobytes() for i, j in zip(cut, cut[1:])]
            n = np.concatenate(total) if total else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(found, pa.binary()),
                                              pa.array(times, pa.binary())], names=names)

    return documents.mapInArrow(run, "doc_id long, n long, terms binary, times binary").where("n > 0")


def _document_frequencies(index: DataFrame, n_terms: int) -> np.ndarray:
    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32)
            total += np.bincount(ids, minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "df"])

    rows = index.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[rows.column("term").to_numpy()] = rows.column("df").to_numpy()
    return out


# ---- scores ----------------------------------------------------------------------------------

def term_weight(n_documents: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_documents + 2) / (2 * df + 1)))


def length_norm(n_terms, n_documents: int, total_terms: int):
    """For numbers and int64 arrays alike."""
    return 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n_terms * n_documents) // max(total_terms, 1)


def _best(rows: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of rows (query, score, doc, doc is null) the k best of each query, in order."""
    query, score, doc, missing = rows
    order = np.lexsort((doc, missing, -score, query))
    query = query[order]
    new = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.empty(0, np.int64)
    place = np.arange(len(query)) - np.repeat(new, np.diff(np.append(new, len(query))))
    return [c[order][place < k] for c in rows]


def _search_block(documents: DataFrame, queries: list[tuple[bytes, collections.Counter]], k: int) -> DataFrame:
    """(key, doc_id, score): the k best documents of each query and task."""
    terms = sorted({t for _, q in queries for t in q})
    number = {t: i for i, t in enumerate(terms)}
    pairs, roots = mine_shared_sums([collections.Counter({number[t]: c for t, c in q.items()}) for _, q in queries], len(terms))
    index = cut_lineage(_index(documents, terms), "search-index")
    n_documents, total = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.array([term_weight(n_documents, int(df)) for df in _document_frequencies(index, len(terms))], np.int64)
    shared = documents.sparkSession.sparkContext.broadcast(
        (weights, levels(len(terms), pairs), np.array(roots), [key for key, _ in queries], len(terms) + len(pairs)))

    def run(batches):
        weights, steps, roots, keys, n_nodes = shared.value
        width = max(1, CELLS // n_nodes)
        best = [np.empty(0, np.int64)] * 3 + [np.empty(0, bool)]
        least = np.ones(len(roots), np.int64)  # what a document must score to rank
        for batch in batches:
            missing = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            docs = batch.column(0).fill_null(0).to_numpy()
            sizes, found, times = batch.column(1).to_numpy(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for a in range(0, batch.num_rows, width):
                part = slice(a, a + width)
                row = np.repeat(np.arange(len(found[part])), [len(f) // 4 for f in found[part]])
                term = np.frombuffer(b"".join(found[part]), np.int32)
                tf = np.frombuffer(b"".join(times[part]), np.int32).astype(np.int64)
                norm = length_norm(sizes[part], n_documents, total)[row]
                sums = np.zeros((n_nodes, len(found[part])), np.int64)
                sums[term, row] = weights[term] * ((SCORE_SCALE * tf) // (TF_SCALE * tf + SATURATION * norm))
                for node, left, right in steps:
                    sums[node] = sums[left] + sums[right]
                score = sums[roots]
                query, at = np.nonzero(score >= least[:, None])
                if len(query):
                    new = (query, score[query, at], docs[part][at], missing[part][at])
                    best = _best([np.concatenate(c) for c in zip(best, new)], k)
                    full = np.bincount(best[0], minlength=len(roots)) >= k
                    lowest = np.full(len(roots), np.iinfo(np.int64).max)
                    np.minimum.at(lowest, best[0], best[1])
                    least = np.where(full, lowest, 1)
        yield pa.RecordBatch.from_arrays([pa.array([keys[q] for q in best[0]], pa.binary()), pa.array(best[2], mask=best[3]),
                                          pa.array(best[1])], names=["key", "doc_id", "score"])

    return index.mapInArrow(run, "key binary, doc_id long, score long")


def _queries(table: DataFrame) -> DataFrame:
    """(item_id, key, terms): the sorted terms of each item, and a digest of them (items without terms are left out)."""
    kind = dict(table.dtypes)["item_id"]

    def run(batches):
        for batch in batches:
            terms = [sorted(query_terms(t)) for t in batch.column(1).to_pylist()]
            key = [hashlib.sha256(" ".join(t).encode()).digest() for t in terms]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.binary()), pa.array(terms, pa.list_(pa.string()))],
                                             names=["item_id", "key", "terms"])
            yield out.filter(pa.array([bool(t) for t in terms], pa.bool_()))

    return table.select("item_id", "text").mapInArrow(run, f"item_id {kind}, key binary, terms array<string>")


def rank_documents(documents: DataFrame, queries: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text) of each query row (item_id, text)."""
    docs = bounded(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = cut_lineage(_queries(queries), "search-queries")
    asked = items.dropDuplicates(["key"])
    blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    found = None
    for i in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == i).select("key", "terms").toArrow().to_pylist()
        if block:
            rows = _search_block(docs, [(r["key"], collections.Counter(r["terms"])) for r in block], k)
            found = rows if found is None else found.union(rows)
    if found is None:
        found = documents.sparkSession.createDataFrame([], "key binary, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = Window.partitionBy("key", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("rank") <= k)
    return items.select("item_id", "key").join(found, "key").select("item_id", "rank", "doc_id", "score")
