"""Spelling variants: words one edit apart, and the form that each rare word varies (operator 11).

Two words are *near* when one inserted, deleted or replaced code point turns one into the other.
Aligned at both ends, that is when their common prefix and common suffix together reach the longer
length minus one.  Words are laid out as padded code-point matrices, left- and right-aligned, and
tiles of words are compared densely, every word of a tile with every other.

Tiles hold only words that can be near.  With the longer length ``c`` of a pair fixed, either the
common prefix reaches ``c // 2`` code points or the common suffix reaches the rest, so words that share
such a half form a bucket; a pair that shares both counts in the prefix bucket only.  A bucket of
more than ``TILE`` words is halved again in the same way within what its words do not have in
common, until what is left is one code point wide; such a bucket holds no more words than there are
letters.  So no bucket is compared as a whole, however many words begin alike.  Buckets of
more than ``BUCKET`` words are halved on Spark, before any task holds one; the others in the task.

A word's form is its near word of largest count (ties: smallest in code-point order), if that has
at least ``RATIO`` times the word's count; its root is the last word of the chain of forms.  Counts grow
tenfold along a chain, so it is followed by a few doubling joins.

Defined cases: null and empty texts have no words; a null ``doc_id`` is written as the empty text where a
document's id enters the altered letter; repeated rows count each; a word without near words has
``n_near`` 0 and null form; equal counts are told apart by code-point order; a text or word of any
length is handled whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded
from ratesmith.session import cut_lineage

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: Words of one dense tile; larger buckets are halved.
TILE = 64
#: Words of one bucket that a task may be given; larger buckets are halved before.
BUCKET = 4096
#: Words that a task is given at once (whole buckets), and cells of the array a step compares.
CHUNK, CELLS = 200_000, 4 << 20
#: Every this many words (by checksum) one letter is left out in the query's word list.
ALTERED_ONE_IN = 31


# ---- words of texts --------------------------------------------------------------------------

_LETTER = K.byte_class(allowed=b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", high=False)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray, table: np.ndarray) -> np.ndarray:
    """crc32 of the spans of a buffer, each continued from the checksum ``begun`` (as zlib.crc32 does)."""
    size = end - start
    out = np.empty(len(start), np.uint32)
    long = size > 64
    for i in np.flatnonzero(long):
        out[i] = zlib.crc32(data[start[i]: end[i]].tobytes(), int(begun[i]))
    order = np.flatnonzero(~long)
    order = order[np.argsort(-size[order], kind="stable")]
    crc = begun[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    left = -np.sort(-size[order])
    for k in range(int(left[0]) if len(left) else 0):
        m = int(np.searchsorted(-left, -k, side="left"))  # spans of more than k bytes come first
        crc[:m] = table[(crc[:m] ^ data[start[order[:m]] + k]) & np.uint32(255)] ^ (crc[:m] >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _letter_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, first): bytes of A-Z, a-z and U+00C0 to U+00FF, and whether each begins a code point."""
    lead = data == 0xC3
    tail = np.zeros(len(data), bool)
    tail[1:] = lead[:-1]
    return _LETTER[data] | lead | tail, ~tail


def _without_one(data, start, end, points, place) -> np.ndarray:
    """The byte positions of code point ``place`` of each run (both bytes of a wide one)."""
    gone = []
    for s, e, n, k in zip(start, end, points, place):
        if e - s == n:
            gone.append(s + k)
        else:
            first = np.flatnonzero((data[s:e] & 0xC0) != 0x80)
            stop = first[k + 1] if k + 1 < n else e - s
            gone += range(s + first[k], s + stop)
    return np.array(gone, np.int64)


def altered_words(documents: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): the words of all texts, lower-cased (A-Z), with their counts.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF.  Where ``ALTERED_ONE_IN`` divides the crc32 of
    ``<doc_id>:<word>``, the code point at the checksum modulo the length is left out.  Words under
    ``least_length`` code points (after that) are not listed.
    """

    def run(batches):
        table = _crc_table()
        for batch in batches:
            data, offsets = K.text_buffer(batch.column(1))
            begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column(0).to_pylist()], np.uint32)
            words = []
            for a, b in K.slices(offsets):
                d = K.lower_ascii(data[offsets[a]: offsets[b]])
                member, first = _letter_bytes(d)
                start, end, row = K.runs(member, offsets[a: b + 1] - offsets[a])
                points = np.concatenate([[0], np.cumsum(first)])
                points = points[end] - points[start]
                enough = points >= least_length
                start, end, row, points = start[enough], end[enough], row[enough], points[enough]
                crc = checksums(d, start, end, begun[a:b][row], table).astype(np.int64)
                altered = crc % ALTERED_ONE_IN == 0
                kept = ~altered | (points > least_length)
                start, end, points, crc, altered = start[kept], end[kept], points[kept], crc[kept], altered[kept]
                gone = _without_one(d, start[altered], end[altered], points[altered], crc[altered] % points[altered])
                mark = np.zeros(len(d) + 1, np.int8)
                mark[start] += 1
                mark[end] -= 1
                inside = np.cumsum(mark[:-1]).astype(bool)
                inside[gone] = False
                at = np.concatenate([[0], np.cumsum(inside)])
                ends = np.concatenate([[0], at[end]]).astype(np.int64)
                words.append(pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(d[inside])]))
            count = pa.chunked_array(words, pa.large_string()).value_counts()
            yield pa.RecordBatch.from_arrays([count.field(0).cast(pa.string()), count.field(1)], names=["word", "n"])

    docs = bounded(documents).select("doc_id", "text")
    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---- near words ------------------------------------------------------------------------------

def halves(entries: DataFrame) -> DataFrame:
    """Each (word, n, c, pl, sl, lim) as its two halves' entries, with their bucket.

    ``c``: the longer length of the pairs sought; the words share ``pl`` first and ``sl`` last code points;
    pairs whose common prefix reaches ``lim`` belong to another bucket.
    """
    middle = "(c - pl - sl)"
    two = (entries.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
           .selectExpr("word", "n", "c", f"IF(side = 0, pl + {middle} div 2, pl) AS pl",
                       f"IF(side = 0, sl, sl + {middle} - {middle} div 2) AS sl", f"IF(side = 0, lim, pl + {middle} div 2) AS lim"))
    two = two.selectExpr("word", "n", *[f"CAST({x} AS INT) AS {x}" for x in ("c", "pl", "sl", "lim")])
    return two.withColumn("bucket", F.expr("xxhash64(c, pl, sl, left(word, pl), right(word, sl))"))


class _Words:
    """Words as one array of code points."""

    def __init__(self, column: pa.ChunkedArray):
        data, offsets = K.text_buffer(column)
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        cut = begins[offsets]
        self.start, self.size = cut[:-1], np.diff(cut)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        self.points = points.astype(np.uint8) if not len(points) or points.max() < 256 else points
        self.hashes = K.Rolling().load(K.mix(points.astype(np.uint64) + np.uint64(1)))

    def middles(self, word: np.ndarray, at: np.ndarray, size: np.ndarray, width: int, right: bool) -> np.ndarray:
        """The middles of words as rows of one width, aligned left or right and padded."""
        column = np.arange(width)
        if right:
            column = column - (width - size)[:, None]
        inside = (column >= 0) & (column < size[:, None])
        # one more than the code point, so that the padding differs from every one
        where = np.where(inside, (self.start[word] + at)[:, None] + column, 0)
        return np.where(inside, self.points[where].astype(np.uint32) + 1, 0).astype(np.uint16 if self.points.itemsize == 1 else np.uint32)


def _halved(words: _Words, entry: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The two halves of entries, as :func:`halves`, with new bucket numbers."""
    half = (entry["c"] - entry["pl"] - entry["sl"]) // 2
    left = entry | {"pl": entry["pl"] + half}
    right = entry | {"sl": entry["c"] - entry["pl"] - half, "lim": entry["pl"] + half}
    both = {k: np.concatenate([left[k], right[k]]) for k in entry}
    w = both["word"]
    begin = words.start[w]
    end = begin + words.size[w]
    key = K.mix(words.hashes.spans(begin, begin + both["pl"])) ^ K.mix(~words.hashes.spans(end - both["sl"], end))
    side = np.arange(len(w)) >= len(half)
    both["bucket"] = K.mix(K.mix(both["bucket"].astype(np.uint64) * np.uint64(2) + side) ^ key)
    return both


def _sized(entry: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The entries in bucket order, and the start and size of each bucket."""
    order = np.lexsort((entry["sl"], entry["pl"], entry["c"], entry["bucket"]))
    entry = {k: v[order] for k, v in entry.items()}
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([entry[k][1:] != entry[k][:-1] for k in ("bucket", "c", "pl", "sl")])
    start = np.flatnonzero(new)
    return entry, start, np.diff(np.append(start, len(order)))


def _tiles(words: _Words, entry: dict, start: np.ndarray, size: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs within buckets of one middle width and of at most ``side`` words each."""
    a, b = [], []
    width = int((entry["c"] - entry["pl"] - entry["sl"])[start[0]])
    step = max(1, CELLS // (side * side * max(width, 1)))
    for i in range(0, len(start), step):
        s, m = start[i: i + step], size[i: i + step]
        slot = s[:, None] + np.arange(side)
        real = np.arange(side) < m[:, None]
        rows = np.where(real, slot, 0).ravel()
        word, pl, sl = entry["word"][rows], entry["pl"][rows], entry["sl"][rows]
        length = words.size[word]
        inner = length - pl - sl
        shape = (len(s), side)
        same = []
        for right in (False, True):
            # the common prefix may reach one code point past the shorter middle, into its word's suffix
            m_ = words.middles(word, pl, inner if right else np.minimum(length - pl, width), width + 1, right).reshape(*shape, width + 1)
            # a column that always differs ends the run of equal ones
            equal = m_[:, :, None, :] == m_[:, None, :, :]
            equal[..., 0 if right else -1] = False
            same.append(np.argmin(equal[..., ::-1] if right else equal, axis=-1))
        length, c = length.reshape(shape), entry["c"][rows].reshape(shape)[:, :1, None]
        limit = (entry["lim"][rows] - pl).reshape(shape)[:, :1, None]
        near = same[0] + same[1] >= (c - (pl + sl).reshape(shape)[:, :1, None]) - 1
        near &= (same[0] < limit) & (np.maximum(length[:, :, None], length[:, None, :]) == c)
        near &= real[:, :, None] & real[:, None, :] & np.triu(np.ones((side, side), bool), 1)
        t, x, y = np.nonzero(near)
        word = word.reshape(shape)
        a.append(word[t, x])
        b.append(word[t, y])
    return np.concatenate(a), np.concatenate(b)


def near_pairs(words: _Words, entry: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The near pairs of all buckets of the entries, each once; buckets above ``TILE`` are halved first."""
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(entry["word"]):
        entry, start, size = _sized(entry)
        middle = entry["c"][start] - entry["pl"][start] - entry["sl"][start]
        ready = (size <= TILE) | (middle <= 1)
        side = np.maximum(2, 1 << np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64))
        kinds = np.where(ready & (size > 1), middle * (1 << 32) + side, -1)
        for kind in np.unique(kinds[kinds >= 0]):
            some = np.flatnonzero(kinds == kind)
            x, y = _tiles(words, entry, start[some], size[some], int(kind % (1 << 32)))
            a.append(x)
            b.append(y)
        more = np.repeat(~ready, size)
        entry = _halved(words, {k: v[more] for k, v in entry.items()}) if more.any() else {"word": np.empty(0)}
    return np.concatenate(a), np.concatenate(b)


_NEAR = "word string, n_near long, near_n long, near string"


def _near_task(table: pa.Table) -> pa.Table:
    """Of each word of the buckets: how many near words they show, and the one of largest count."""
    code = pc.dictionary_encode(table.column("word").combine_chunks())
    code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
    names = code.dictionary
    words = _Words(names)
    entry = {k: table.column(k).to_numpy().astype(np.int64) for k in ("bucket", "c", "pl", "sl", "lim")}
    entry["word"] = code.indices.to_numpy().astype(np.int64)
    entry["bucket"] = entry["bucket"].view(np.uint64)
    n = np.zeros(len(names), np.int64)
    n[entry["word"]] = table.column("n").to_numpy()
    place = np.empty(len(names), np.int64)
    place[pc.sort_indices(names.cast(pa.large_binary())).to_numpy()] = np.arange(len(names))
    a, b = near_pairs(words, entry)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((place[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(a)))
    return pa.table([names.take(pa.array(a[first])), pa.array(count), pa.array(n[b[first]]), names.take(pa.array(b[first]))],
                    names=["word", "n_near", "near_n", "near"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near) of each of the distinct words (word, n) that has a near word: the number, and the best."""
    entries = halves(words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("c"))
                     .where("c > 0").selectExpr("word", "n", "c", "0 AS pl", "0 AS sl", "c + 1 AS lim"))
    ready = None
    while True:
        entries = cut_lineage(entries, "word-buckets")
        same = ["bucket", "c", "pl", "sl"]
        large = entries.groupBy(*same).agg(F.count("*").alias("k")).where((F.col("k") > BUCKET) & (F.col("c") - F.col("pl") - F.col("sl") > 1))
        large = cut_lineage(large.drop("k"), "large-buckets")
        if large.isEmpty():
            ready = entries if ready is None else ready.unionByName(entries)
            break
        done = entries.join(large, same, "left_anti")
        ready = done if ready is None else ready.unionByName(done)
        entries = halves(entries.join(large, same, "left_semi"))
    chunks = max(1, -(-ready.count() // CHUNK))
    found = (ready.withColumn("chunk", F.pmod("bucket", F.lit(chunks))).groupBy("chunk")
             .applyInArrow(lambda table: _near_task(table), _NEAR))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near")))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form) whose chains end: the last form of each word's chain."""
    out = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        out = cut_lineage(out.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                F.col("next").isNotNull().alias("moved")), "roots")
        if out.where("moved").isEmpty():
            return out.select("word", "root")
        out = out.select("word", "root")


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of each of the distinct words (word, n)."""
    words = words.select("word", F.col("n").cast("long").alias("n"))
    near = cut_lineage(words.join(near_words(words), "word", "left"), "near-words")
    near = near.withColumn("varies", F.coalesce(F.col("near_n") >= ratio * F.col("n"), F.lit(False)))
    roots = roots_of(near.where("varies").select("word", F.col("near").alias("form")))
    return near.join(roots, "word", "left").select(
        "word", F.when(F.col("varies"), F.col("near")).alias("form"), F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("varies"), F.col("near_n")).alias("form_n"))


def spelling_report(documents: DataFrame) -> DataFrame:
    """The variant groups of the (altered) words of all documents that occur at least ``LEAST_COUNT`` times."""
    return variant_groups(cut_lineage(altered_words(documents).where(F.col("n") >= LEAST_COUNT), "words"))
