"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets (operator 4).

A document's set holds its distinct shingles of ``SHINGLE`` words (A-Z lower-cased; with
fewer words the whole sequence is one shingle).  Two documents link when their sets'
Jaccard similarity is at least 80 %.  Equal sets are one set; copies are never paired.

*Light sets* (up to a boundary size): sets of a and b shingles link exactly when they share
``o(a, b)``, the least overlap that is 80 % similar, so each set enumerates its subsets of
that fixed size for every size of partner; sets with a common subset link.  No pairs are made.

*Heavy sets*: inverted lists are scanned.  In one fixed order (shingles of very many documents
last, then by hash) linked sets share several of their first shingles, so a set is listed
under a prefix only.  The lists are built one bucket of shingles at a time; a set that shares
too few prefix shingles with anything is done.  For the others the rarest of the shared
prefix shingles suffice.  Along those lists sets are first verified against a few hubs, which
joins most of a near-copy group; then only sets of *different* components that lie on
connected lists are verified against each other, block against block, so every remaining
link is found and no task holds more than two blocks.

*The boundary* minimises an estimated cost over the histogram of set sizes: subsets
enumerated below it, against prefix entries and a verification above it.

Defined cases: null and empty texts and texts without words have an empty set and are linked
with nothing, not even each other; equal rows are copies; a null doc_id takes part (its row
shows the smallest non-null id of its component, else null); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded
from ratesmith.llm.links import linked_components
from ratesmith.llm.suffixes import _planes, _unplanes
from ratesmith.session import cut_lineage

SHINGLE = 5
SLAB_BYTES = 4 << 20
#: Light sets are at most this large, whatever the costs (a set of 24 has 10,626 subsets of 20).
LIGHT_MOST = 24
#: Cost of verifying a heavy set, in enumerated subsets or list entries.
VERIFY_COST = 30
#: A shingle in more than this share of a slab's sets, and of all sets, is ordered last.
COMMON_SHARE, COMMON_LEAST = 1 / 400, 8
#: Sets to verify are picked out by a broadcast list of ids up to this many (8 bytes each), by a shuffle beyond.
BROADCAST_IDS = 4_000_000


def overlap_needed(a: int, b: int) -> int:
    """The least overlap with 100 * overlap >= 80 * union."""
    return -(-4 * (a + b) // 9)


def _shared_least(n):
    """The least overlap of a set of n with any linked set."""
    return -(-4 * n // 5)


def _extra(n):
    return np.maximum(1, n // 5)


def prefix_size(n):
    """Prefix length: linked sets share at least :func:`prefix_shared` shingles of their prefixes."""
    return np.minimum(n, n - _shared_least(n) + _extra(n))


def prefix_shared(n):
    return np.minimum(_extra(n), _extra(_shared_least(n)))


def subset_count(n: int) -> int:
    return sum(math.comb(n, overlap_needed(n, m)) for m in _partners(n))


def _partners(n: int):
    return [m for m in range(max(1, _shared_least(n)), 5 * n // 4 + 1) if overlap_needed(n, m) <= min(n, m)]


def choose_boundary(sizes: dict[int, int]) -> int:
    """The largest light size, by estimated cost over {set size: sets}, sizes up to LIGHT_MOST * 5 / 4."""
    def cost(s: int) -> int:
        light = sum(c * subset_count(n) for n, c in sizes.items() if 0 < n <= s)
        heavy = sum(c * (int(prefix_size(n)) + VERIFY_COST) for n, c in sizes.items() if n >= _shared_least(s + 1))
        return light + heavy

    return min(range(0, LIGHT_MOST + 1), key=lambda s: (cost(s), s))


# ---- sets ---------------------------------------------------------------------------------

def _sets(data, offsets, values, words, shingles):
    """(row, hash) of the distinct shingles of a slice, ordered by row and hash."""
    data = K.lower_ascii(data)
    start, end, row = K.runs(K.SPACED_WORD[data], offsets)
    word = K.mix(words.load(values[data]).spans(start, end) ^ (end - start).astype(np.uint64))
    shingles.load(word)
    n = K.counts(row, len(offsets) - 1)
    at = K.windows(row, SHINGLE)
    first = np.cumsum(n) - n
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    owner = np.concatenate([row[at], short])
    h = K.mix(np.concatenate([shingles.spans(at, at + SHINGLE),
                              shingles.spans(first[short], first[short] + n[short]) ^ n[short].astype(np.uint64)]))
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.empty(0, bool)
    return owner[new], h[new]


def _signatures(row, h, n_rows) -> np.ndarray:
    """Two 64-bit sums of mixed shingles per row: equal for equal sets."""
    out = np.empty((n_rows, 2), np.uint64)
    ends = np.searchsorted(row, np.arange(n_rows + 1))
    for k, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(K.mix(h * np.uint64(salt | 1) + np.uint64(salt)), out=total[1:])
        out[:, k] = total[ends[1:]] - total[ends[:-1]]
    return out


def _fixed_binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a 2-d array."""
    raw = np.ascontiguousarray(rows)
    width = raw.dtype.itemsize * raw.shape[1]
    ends = np.arange(len(raw) + 1, dtype="<i4") * width
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])


def _slabs(batch, text_at, slab=SLAB_BYTES):
    """(first row, rows, row of each shingle, shingle) of slabs of a batch."""
    values, words, shingles = K.byte_values(), K.Rolling(), K.Rolling()
    data, offsets = K.text_buffer(batch.column(text_at))
    for a, b in K.slices(offsets, slab):
        parts = []
        for c, e in K.slices(offsets[a: b + 1], K.SLICE_BYTES):
            lo, hi = offsets[a + c], offsets[a + e]
            row, h = _sets(data[lo:hi], offsets[a + c: a + e + 1] - lo, values, words, shingles)
            parts.append((row + c, h))
        yield a, b - a, *(np.concatenate(x) for x in zip(*parts))


def _describe(batches):
    """Per document: set size and signature, and the set itself if it may be light; plus locally common shingles."""
    for batch in batches:
        for a, n_rows, row, h in _slabs(batch, 1):
            n = K.counts(row, n_rows)
            sign = _signatures(row, h, n_rows)
            ends = np.concatenate([[0], np.cumsum(n)])
            sets = [h[ends[i]: ends[i + 1]].tobytes() if 0 < n[i] <= LIGHT_MOST else None for i in range(n_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, n_rows), pa.array(n), _fixed_binary(sign), pa.array(sets, pa.binary()),
                 pa.nulls(n_rows, pa.int64()), pa.nulls(n_rows, pa.int64())],
                names=["doc_id", "n", "sig", "items", "shingle", "sets"])
            _, once = np.unique(sign.view("V16").ravel(), return_index=True)
            distinct = np.zeros(n_rows, bool)
            distinct[once] = True
            shingle, times = np.unique(h[distinct[row]], return_counts=True)
            common = times >= max(COMMON_LEAST, COMMON_SHARE * distinct.sum())
            k = int(common.sum())
            if k:
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()),
                     pa.array(shingle[common].view(np.int64)), pa.array(times[common])],
                    names=["doc_id", "n", "sig", "items", "shingle", "sets"])


# ---- light sets ---------------------------------------------------------------------------

def _subset_keys(boundary: int):
    def run(batches):
        for batch in batches:
            sign, keys, lesser = [], [], []
            for sig, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = np.frombuffer(items, np.uint64)
                n = len(h)
                for m in _partners(n):
                    if m > boundary:
                        continue
                    size = overlap_needed(n, m)
                    chosen = np.array(list(combinations(range(n), size)))
                    tag = min(n, m) * 1000 + max(n, m)
                    pair = [K.mix(K.mix(h + np.uint64(s))[chosen].sum(axis=1, dtype=np.uint64) + np.uint64(tag * s % (1 << 64)))
                            for s in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
                    keys.append(np.stack(pair, axis=1))
                    sign += [sig] * len(chosen)
                    lesser += [n <= m] * len(chosen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sign, pa.binary()), _fixed_binary(np.concatenate(keys) if keys else np.empty((0, 2), np.uint64)),
                 pa.array(lesser, pa.bool_())], names=["sig", "subset", "lesser"])

    return run


def _light_edges(sets: DataFrame, boundary: int) -> DataFrame:
    keys = sets.where((F.col("n") <= boundary) & (F.col("n") > 0)).select("sig", "items").mapInArrow(
        _subset_keys(boundary), "sig binary, subset binary, lesser boolean")
    # a subset of o(a, b) links sets of a with all of a and b, but not two sets of the greater size
    hubs = keys.where("lesser").groupBy("subset").agg(F.min("sig").alias("hub"))
    return keys.join(hubs, "subset").where("sig <> hub").select("sig", "hub").distinct()


# ---- heavy sets: inverted lists -----------------------------------------------------------

HASH_BYTES = 5


def _prefix_rows(least: int, common: np.ndarray, common_sets: np.ndarray, buckets: int):
    """Prefix entries by bucket of shingles; entries of common shingles need no list to be known as shared."""

    def run(batches):
        for batch in batches:
            for a, n_rows, row, h in _slabs(batch, 1):
                n = K.counts(row, n_rows)
                sign = _signatures(row, h, n_rows)
                _, once = np.unique(sign.view("V16").ravel(), return_index=True)
                use = np.zeros(n_rows, bool)
                use[once] = True
                use &= n >= least
                h, row = h[use[row]], row[use[row]]
                slot = np.minimum(np.searchsorted(common, h), max(len(common) - 1, 0))
                last = common[slot] == h if len(common) else np.zeros(len(h), bool)
                order = np.lexsort((h, last, row))
                row, h, last, slot = row[order], h[order], last[order], slot[order]
                first = np.searchsorted(row, np.arange(n_rows))
                kept = np.arange(len(row)) - first[row] < prefix_size(n)[row]
                row, h, last, slot = row[kept], h[kept], last[kept], slot[kept]
                names = ["bucket", "sig", "n", "x", "df", "payload"]
                if last.any():
                    r = row[last]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((sign[r, 0] % np.uint64(buckets)).astype(np.int32)), _fixed_binary(sign[r]), pa.array(n[r].astype(np.int32)),
                         pa.array(h[last].view(np.int64)), pa.array(common_sets[slot[last]]), pa.nulls(len(r), pa.binary())], names=names)
                    row, h = row[~last], h[~last]
                if not len(row):
                    continue
                bucket = ((h >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int32)
                order = np.lexsort((h, row, bucket))
                row, h, bucket = row[order], h[order], bucket[order]
                cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                blobs = []
                for i, j in zip(cut, cut[1:]):
                    at = i + np.flatnonzero(np.concatenate([[True], row[i + 1: j] != row[i: j - 1]]))
                    size = np.diff(np.append(at, j))
                    blobs.append(np.array([len(at), j - i], "<i4").tobytes() + sign[row[at]].tobytes()
                                 + _planes(n[row[at]], 4) + _planes(size, 4) + _planes(h[i:j], HASH_BYTES))
                k = len(blobs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cut[:-1]]), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()),
                     pa.nulls(k, pa.int64()), pa.array(blobs, pa.binary())], names=names)

    return run


_ENTRY = pa.schema([("sig", pa.binary()), ("n", pa.int32()), ("x", pa.int64()), ("df", pa.int64())])


def _list_bucket(table: pa.Table) -> pa.Table:
    """Builds the inverted lists of one bucket; gives the entries of lists of two or more sets."""
    out = [table.filter(table.column("sig").is_valid()).select(_ENTRY.names).cast(_ENTRY)]
    sent = table.filter(table.column("sig").is_null())
    if sent.num_rows:
        bucket = sent.column("bucket")[0].as_py()
        signs, sizes, owner, hashes, base = [], [], [], [], 0
        for raw in sent.column("payload").to_pylist():
            view = memoryview(raw)
            k, n = (int(v) for v in np.frombuffer(view, "<i4", 2))
            view = view[8:]
            signs.append(np.frombuffer(view, "V16", k))
            view = view[16 * k:]
            sizes.append(_unplanes(view, k, 4).astype(np.int32))
            owner.append(np.repeat(np.arange(base, base + k), _unplanes(view[4 * k:], k, 4).astype(np.int64)))
            hashes.append(_unplanes(view[8 * k:], n, HASH_BYTES))
            base += k
        sign, size, owner, h = (np.concatenate(c) for c in (signs, sizes, owner, hashes))
        _, first, same = np.unique(sign, return_index=True, return_inverse=True)
        owner = same[owner]
        order = np.lexsort((owner, h))
        owner, h = owner[order], h[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
        owner, h = owner[new], h[new]
        _, which, df = np.unique(h, return_inverse=True, return_counts=True)
        shared = df[which] > 1
        owner, h, df = first[owner[shared]], h[shared], df[which[shared]]
        x = h.astype(np.int64) | (np.int64(bucket) << np.int64(8 * HASH_BYTES))
        rows = np.ascontiguousarray(sign[owner]).view(np.uint64).reshape(-1, 2)
        out.append(pa.table([_fixed_binary(rows), pa.array(size[owner]), pa.array(x), pa.array(df.astype(np.int64))], schema=_ENTRY))
    return pa.concat_tables(out)


def _full_sets(batches):
    for batch in batches:
        for a, n_rows, row, h in _slabs(batch, 0):
            n = K.counts(row, n_rows)
            ends = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays(
                [_fixed_binary(_signatures(row, h, n_rows)),
                 pa.array([h[ends[i]: ends[i + 1]].tobytes() for i in range(n_rows)], pa.binary())], names=["sig", "items"])


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= 80 * (len(a) + len(b) - shared)


def _verify_pairs(left: list[bytes], right: list[bytes]) -> list[bool]:
    return [_linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(left, right)]


def _verify_block(items: list[bytes], component: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Which sets of one or two blocks link: their overlaps, by products of slices of the incidence matrix."""
    sets = [np.frombuffer(x, np.uint64) for x in items]
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    owner, column = owner[times[column] > 1], number[column[times[column] > 1]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [lo, lo + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[i:j], column[i:j] - lo] = 1
        shared += part @ part.T
    shared = np.rint(shared).astype(np.int64)
    return 100 * shared >= 80 * (size[:, None] + size[None, :] - shared)


def similar_groups(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row."""
    spark = documents.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = bounded(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = cut_lineage(docs.mapInArrow(_describe, "doc_id long, n long, sig binary, items binary, shingle long, sets long"), "sets")
    rows = seen.where("sig IS NOT NULL")
    distinct = cut_lineage(rows.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("one"), F.first("n").alias("n"),
                                                                 F.first("items").alias("items")), "distinct-sets")
    sizes = {r["n"]: r["count"] for r in distinct.where(F.col("n") <= LIGHT_MOST * 5 // 4).groupBy("n").count().collect()}
    boundary = choose_boundary(sizes)
    light = _light_edges(distinct, boundary)
    total = distinct.count()
    common = (seen.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("sets").alias("sets"))
              .where(F.col("sets") >= total * COMMON_SHARE).toPandas())
    shingle = common["shingle"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(shingle)
    entries = (docs.mapInArrow(_prefix_rows(_shared_least(boundary + 1), shingle[order], common["sets"].to_numpy(dtype=np.int64)[order], buckets),
                               "bucket int, sig binary, n int, x long, df long, payload binary")
               .repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_list_bucket, "sig binary, n int, x long, df long"))
    # linked sets share `need` prefix shingles: fewer shared ones rule a set out, and all but need - 1 of the rarest suffice
    n = F.col("n").cast("long")
    extra = lambda size: F.greatest(F.lit(1), F.floor(size / 5))
    need = F.least(extra(n), extra(F.ceil(4 * n / 5)))
    entries = (entries.groupBy("sig").agg(F.first("n").alias("n"), F.sort_array(F.collect_set(F.struct("df", "x"))).alias("shared"))
               .withColumn("need", need.cast("int")).where("size(shared) >= need")
               .select("sig", "n", F.explode(F.expr("slice(shared, 1, size(shared) - need + 1)")).alias("e"))
               .select("sig", "n", F.col("e.x").alias("x")))
    entries = cut_lineage(entries, "entries")
    wanted = cut_lineage(entries.select("sig").distinct().join(distinct.select("sig", "one"), "sig"), "wanted-sets")
    source = docs
    if wanted.count() <= BROADCAST_IDS:
        source = source.join(F.broadcast(wanted.select(F.coalesce("one", F.lit(-1)).alias("w"))),
                             F.coalesce("doc_id", F.lit(-1)) == F.col("w"), "left_semi")
    else:
        source = source.join(wanted.select("one"), F.col("doc_id").eqNullSafe(F.col("one")), "left_semi")
    sets = cut_lineage(source.select("text").mapInArrow(_full_sets, "sig binary, items binary")
                       .join(wanted.select("sig"), "sig", "left_semi").dropDuplicates(["sig"]), "full-sets")
    # sets whose sizes differ by more than a quarter cannot link; a band holds sizes that can
    bands = entries.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / math.log(1.25)))
    label = linked_components(bands.select("sig", "x", "band"), sets.select("sig", F.col("items").alias("item")),
                              _verify_pairs, _verify_block, light)
    label = label.select(F.col("node").alias("sig"), F.col("component").alias("label"))
    grouped = distinct.select("sig", "one").join(label, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    least = grouped.groupBy("label").agg(F.min("one").alias("component_id"))
    by_sig = grouped.join(least, "label").select("sig", "component_id")
    full = rows.where("n > 0").join(by_sig, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one_of_each_group(documents: DataFrame) -> DataFrame:
    """The documents without those that have a linked document of a smaller id.

    Rows of one id stand or fall together: all go if one of them is linked to a smaller id, else all
    stay, repeats included.  Rows without an id stay.
    """
    groups = similar_groups(documents)
    later = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return documents.join(later, "doc_id", "left_anti").select(*documents.columns)
