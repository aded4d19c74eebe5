"""Exact repeats of ``LENGTH`` bytes, by difference-cover blockwise suffix sorting (operator 10).

Every text is a string of UTF-8 bytes; a byte is removed when it lies in a ``LENGTH``-byte
string that also starts anywhere else, in the same text or another.  Suffixes need ordering
only by their first ``LENGTH`` bytes, so only suffixes that tie for that long matter.

1. *Cover sample.*  A difference cover D modulo v has, for any two positions i and j, an
   offset d < v with i+d and j+d both in the sample (positions whose residue is in D).  The
   sample suffixes are dealt into buckets by a hash of their first ``LENGTH - v + 1`` bytes and
   sorted one bucket at a time; equal neighbours share a rank.
2. *Long ties.*  Two suffixes that tie for ``LENGTH`` bytes have, within v bytes, sample
   suffixes of one rank.  A suffix without a shared rank ahead of it within v bytes cannot
   tie and is left out: what remains is little more than the repeats themselves.
3. *Suffix buckets.*  The remaining suffixes are dealt into buckets by the least hash of the
   short grams in their first ``LENGTH`` bytes, which neighbouring suffixes share, so they
   travel as one piece of text.  Each bucket is sorted on its own by a 128-bit fingerprint of
   ``LENGTH`` bytes; equal neighbours are repeats.

A task holds one bucket or one slab of text.  Before each exchange a task answers the ties
it can see itself and sends one suffix of each class, so a passage found in a third of all
documents is sent once per slab; grams that are still too common are not used as bucket keys.
Whole texts that are equal are told by their SHA-256 and take part once.  Sample ranks travel
under 60 bits of it; ranges to remove under a number given to each candidate text.

Defined cases: null and empty texts have no bytes and lose none; texts shorter than
``LENGTH`` lose none; repeated rows are copies of each other, whatever their ids; null ids
and other columns do no harm.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded
from ratesmith.session import cut_lineage

LENGTH = 400
SLAB_BYTES = 4 << 20
#: Hexadecimal digits of a text's SHA-256 that its sample ranks travel under.
KEY_DIGITS = 15
#: Buckets per shuffle partition: a task holds one bucket at a time.
BUCKETS_PER_TASK = 6
#: A gram that keys more than this share of all pieces (and at least HOT_LEAST) is no bucket key.
HOT_SHARE, HOT_LEAST = 1 / 2000, 500
#: Candidate texts are picked out by a broadcast list of keys up to this many (16 bytes each), by a shuffle beyond.
BROADCAST_KEYS = 2_000_000

# Perfect difference sets (every residue is a difference exactly once), by modulus.
PERFECT_COVERS = {
    3: (0, 1),
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    31: (1, 5, 11, 24, 25, 27),
    133: (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121),
}


def difference_cover(length: int) -> tuple[int, tuple[int, ...]]:
    """(v, D) with the largest listed modulus of at most a third of ``length`` (and a bit)."""
    v = max(m for m in PERFECT_COVERS if m == 3 or m <= length // 3)
    return v, PERFECT_COVERS[v]


# ---- fixed-width arrays as bytes, one plane per byte so that small values compress --------

def _planes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(raw: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width).reshape(width, n).T
    return out.view("<u8").ravel()


HASH_BYTES = 5  # beside the bucket, which is taken from the hash's top bits


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int32)


def pack_sample(key: np.ndarray, pos: np.ndarray, h: np.ndarray) -> bytes:
    """Sample suffixes of one bucket, ordered by (key, pos)."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(first, len(key)))
    gaps = np.diff(pos, prepend=0)
    gaps[first] = pos[first]
    return (np.array([len(first), len(key)], "<i4").tobytes() + key[first].astype("<i8").tobytes()
            + _planes(sizes, 4) + _planes(gaps, 4) + _planes(h, HASH_BYTES))


def unpack_sample(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    view = memoryview(raw)
    n_keys, n = np.frombuffer(view, "<i4", 2)
    keys = np.frombuffer(view[8:], "<i8", n_keys)
    view = view[8 + 8 * n_keys:]
    sizes = _unplanes(view, n_keys, 4).astype(np.int64)
    gaps = _unplanes(view[4 * n_keys:], n, 4).astype(np.int64)
    h = _unplanes(view[4 * n_keys + 4 * n:], n, HASH_BYTES)
    total = np.cumsum(gaps)
    before = np.cumsum(sizes) - sizes
    return np.repeat(keys, sizes), total - np.repeat(np.concatenate([[0], total])[before], sizes), h


def _by_key(key: np.ndarray, payload: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(keys, int32 payloads as binary) with one row per key; payload rows are sorted by (key, value)."""
    order = np.lexsort((payload[:, 0], key))
    key, payload = key[order], np.ascontiguousarray(payload[order].astype("<i4"))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
    ends = np.append(first, len(key)) * payload.shape[1] * 4
    return pa.array(key[first], pa.int64()), pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(payload.tobytes())])


# ---- step 1: the cover sample -------------------------------------------------------------

def _cover_sample(length: int, buckets: int):
    v, cover = difference_cover(length)
    width = length - v + 1

    def run(batches):
        member = np.zeros(v, bool)
        member[list(cover)] = True
        values, rolling = K.byte_values(), K.Rolling()
        for batch in batches:
            data, offsets = K.text_buffer(batch.column(1))
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in K.slices(offsets, SLAB_BYTES):
                starts, ends = offsets[a:b], offsets[a + 1: b + 1]
                once = np.zeros(b - a, bool)
                copies = batch.column(2).slice(a, b - a).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                once[np.unique(copies, return_index=True)[1]] = True
                once &= ends - starts >= length
                found = []
                for lo in range(int(starts[0]), int(ends[-1]), K.SLICE_BYTES):
                    hi = min(lo + K.SLICE_BYTES, int(ends[-1]))
                    r0, r1 = np.searchsorted(ends, [lo, hi - 1], side="right")
                    left, right = np.maximum(starts[r0: r1 + 1], lo), np.minimum(ends[r0: r1 + 1], hi)
                    row = np.repeat(np.arange(r0, r1 + 1), right - left)
                    at = np.arange(lo, hi)
                    pick = member[(at - starts[row]) % v] & once[row] & (at + width <= ends[row])
                    row, at = row[pick], at[pick]
                    rolling.load(values[data[lo: min(hi + width, int(ends[-1]))]])
                    found.append((row, at, K.mix(rolling.spans(at - lo, at - lo + width))))
                row, at, h = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3
                if not len(row):
                    continue
                pos, key = at - starts[row], keys[a:b][row]
                # classes seen here: every member of a class of two or more is answered at once
                order = np.argsort(h, kind="stable")
                same = h[order][1:] == h[order][:-1]
                head = order[np.concatenate([[True], ~same])]
                tied = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
                if len(tied):
                    who, payload = _by_key(key[tied], pos[tied, None])
                    to = pa.array(np.mod(who.to_numpy(zero_copy_only=False), buckets), pa.int32())
                    yield pa.RecordBatch.from_arrays([to, who, payload], names=["bucket", "key", "payload"])
                head = head[np.lexsort((pos[head], key[head], _bucket(h[head], buckets)))]
                bucket = _bucket(h[head], buckets)
                cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                blobs = [pack_sample(key[head[i:j]], pos[head[i:j]], h[head[i:j]]) for i, j in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cut[:-1]], pa.int32()), pa.nulls(len(blobs), pa.int64()), pa.array(blobs, pa.binary())],
                    names=["bucket", "key", "payload"])

    return run


def _rank_bucket(table: pa.Table) -> pa.Table:
    """Sorts one bucket of sample suffixes; answers (key, positions) of those that share a rank."""
    answered = table.filter(table.column("key").is_valid())
    sent = [unpack_sample(raw) for raw in table.filter(table.column("key").is_null()).column("payload").to_pylist()]
    out = [answered.select(["key", "payload"])]
    if sent:
        key, pos, h = (np.concatenate(c) for c in zip(*sent))
        order = np.lexsort((pos, key, h))
        key, pos, h = key[order], pos[order], h[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (key[1:] != key[:-1]) | (pos[1:] != pos[:-1])])
        key, pos, h = key[new], pos[new], h[new]  # a copied text was sent by several tasks
        same = h[1:] == h[:-1]
        tied = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        who, payload = _by_key(key[tied], pos[tied, None])
        out.append(pa.table([who, payload], names=["key", "payload"]))
    return pa.concat_tables([t.cast(pa.schema([("key", pa.int64()), ("payload", pa.binary())])) for t in out])


# ---- steps 2 and 3: suffixes that may tie, by bucket --------------------------------------

def _spread(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in any [start, end)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def _sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """min(x[i:i+k]) for every i with a whole window."""
    n = len(x) - k + 1
    if n <= 0:
        return x[:0]
    pad = -len(x) % k
    blocks = np.concatenate([x, np.full(pad, ~np.uint64(0))]).reshape(-1, k)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[k - 1: k - 1 + n])


class Fingerprints:
    """128-bit fingerprints of fixed-length strings."""

    def __init__(self):
        self.parts = [(K.byte_values(s), K.Rolling(b)) for s, b in ((1, 0x9E3779B97F4A7C15), (2, 0xD1342543DE82EF95))]

    def of(self, data: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
        return [K.mix(rolling.load(values[data]).spans(at, at + length)) for values, rolling in self.parts]


def _ties(print_a: np.ndarray, print_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one index of each class, all indexes of classes of two or more)."""
    order = np.lexsort((print_b, print_a))
    a, b = print_a[order], print_b[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    return order[np.concatenate([[True], ~same])], order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]


def _runs_of(key: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive positions of a key as (key, [start, end)) rows."""
    order = np.lexsort((pos, key))
    key, pos = key[order], pos[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (pos[1:] != pos[:-1] + 1)]) if len(key) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(key)) - 1
    return key[first], np.stack([pos[first], pos[last] + 1], axis=1) if len(first) else np.empty((0, 2), np.int64)


def _pieces(batch: pa.RecordBatch, length: int, hot: np.ndarray):
    """Per slab: answers found in it, and the pieces of text whose suffixes must meet others."""
    v, _ = difference_cover(length)
    gram = max(2, length // 8)
    prints, values, rolling = Fingerprints(), K.byte_values(3), K.Rolling()
    keys = batch.column(0).to_numpy(zero_copy_only=False)
    data, offsets = K.text_buffer(batch.column(1))
    answers = batch.column(2)
    for a, b in K.slices(offsets, K.SLICE_BYTES):
        d, o = data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]
        size = np.diff(o)
        shared = [np.concatenate([np.frombuffer(x, "<i4") for x in answers[r].as_py()]) + o[r - a] for r in range(a, b)]
        row = np.repeat(np.arange(b - a), [len(x) for x in shared])
        ahead = np.concatenate(shared)
        stop = np.minimum(ahead, (o[1:] - length)[row]) + 1
        start = np.maximum(ahead - v + 1, o[row])
        at = np.flatnonzero(_spread(start[stop > start], stop[stop > start], len(d)))
        if not len(at):
            continue
        row = np.repeat(np.arange(b - a), size)[at]
        key, pos = keys[a:b][row], at - o[row]
        print_a, print_b = prints.of(d, at, length)
        head, tied = _ties(print_a, print_b)
        keep = np.sort(head)
        grams = K.mix(rolling.load(values[d]).spans(np.arange(len(d) - gram + 1), np.arange(gram, len(d) + 1)))
        if len(hot):
            grams[hot[np.minimum(np.searchsorted(hot, grams), len(hot) - 1)] == grams] = ~np.uint64(0)
        least = _sliding_min(grams, length - gram + 1)[at[keep]]
        plain = least == ~np.uint64(0)  # only common grams: such suffixes travel alone
        least[plain] = print_a[keep][plain]
        new = np.concatenate([[True], (np.diff(at[keep]) != 1) | (least[1:] != least[:-1]) | (row[keep][1:] != row[keep][:-1])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(keep)) - 1
        yield (_runs_of(key[tied], pos[tied]), key[keep][first], pos[keep][first], least[first],
               [d[i: j + length].tobytes() for i, j in zip(at[keep][first], at[keep][last])])


def _piece_rows(length: int, hot: np.ndarray, buckets: int):
    def run(batches):
        for batch in batches:
            for (who, ranges), key, pos, least, text in _pieces(batch, length, hot):
                if len(who):
                    who, payload = _by_key(who, ranges)
                    to = pa.array(np.mod(who.to_numpy(zero_copy_only=False), buckets), pa.int32())
                    yield pa.RecordBatch.from_arrays([to, who, pa.nulls(len(who), pa.int32()), payload],
                                                     names=["bucket", "key", "pos", "payload"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_bucket(K.mix(least), buckets)), pa.array(key), pa.array(pos.astype(np.int32)), pa.array(text, pa.binary())],
                    names=["bucket", "key", "pos", "payload"])

    return run


def _common_grams(length: int):
    def run(batches):
        for batch in batches:
            for _, _, _, least, _ in _pieces(batch, length, np.empty(0, np.uint64)):
                gram, n = np.unique(least, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], names=["gram", "n"])

    return run


def _sort_bucket(length: int):
    """Sorts the suffixes of one bucket; answers (key, [start, end) of suffixes that tie)."""

    def run(table: pa.Table) -> pa.Table:
        prints = Fingerprints()
        answered = table.filter(table.column("pos").is_null()).select(["key", "payload"])
        sent = table.filter(table.column("pos").is_valid())
        out = [answered]
        if sent.num_rows:
            text = sent.column("payload").combine_chunks().cast(pa.large_binary())
            data, offsets = K.text_buffer(text.cast(pa.large_binary()).view(pa.large_string()))
            size = np.diff(offsets) - length + 1
            first = np.repeat(offsets[:-1], size)
            step = np.arange(len(first)) - np.repeat(np.cumsum(size) - size, size)
            key = np.repeat(sent.column("key").to_numpy(), size)
            pos = np.repeat(sent.column("pos").to_numpy().astype(np.int64), size) + step
            found = []
            for lo in range(0, len(first), K.SLICE_BYTES):
                at = (first + step)[lo: lo + K.SLICE_BYTES]
                found.append(prints.of(data[at[0]: at[-1] + length], at - at[0], length))
            print_a, print_b = (np.concatenate(c) for c in zip(*found))
            _, tied = _ties(print_a, print_b)
            who, payload = _by_key(*_runs_of(key[tied], pos[tied]))
            out.append(pa.table([who, payload], names=["key", "payload"]))
        return pa.concat_tables([t.cast(pa.schema([("key", pa.int64()), ("payload", pa.binary())])) for t in out])

    return run


# ---- the operator -------------------------------------------------------------------------

def _cut_out(text: bytes, ranges: list[bytes], length: int) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, removed runs) given the tying suffixes of a text."""
    r = np.concatenate([np.frombuffer(x, "<i4") for x in ranges]).reshape(-1, 2).astype(np.int64)
    gone = _spread(r[:, 0], r[:, 1] - 1 + length, len(text))
    starts = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), starts


def repeated_suffixes(documents: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(texts, answers): one row (key, sha, text) per distinct candidate text, and per key the
    [start, end) ranges of suffixes that tie with another for ``length`` bytes."""
    spark: SparkSession = documents.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(tasks * BUCKETS_PER_TASK, 1 << 16)
    docs = bounded(documents).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256)) \
        .withColumn("key", F.conv(F.substring("sha", 1, KEY_DIGITS), 16, 10).cast("long")) \
        .where(F.octet_length("text") >= length)
    ranked = (docs.select("key", "text", "sha").mapInArrow(_cover_sample(length, buckets), "bucket int, key long, payload binary")
              .repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_rank_bucket, "key long, payload binary")
              .groupBy("key").agg(F.collect_list("payload").alias("shared")))
    ranked = cut_lineage(ranked, "cover-ranks")
    one = docs.groupBy("sha").agg(F.min("doc_id").alias("one"), F.first("key").alias("key"))
    wanted = cut_lineage(one.join(ranked.select("key"), "key", "left_semi"), "candidate-keys")
    source = docs
    if wanted.count() <= BROADCAST_KEYS:
        source = docs.join(F.broadcast(wanted.select("key").distinct()), "key", "left_semi")
    # both keys of the join are unique together, so the copies of one text do not meet in one task
    chosen = wanted.select(F.col("sha").alias("wanted_sha"), "one")
    texts = (source.join(chosen, (F.col("sha") == F.col("wanted_sha")) & F.col("doc_id").eqNullSafe(F.col("one")))
             .select("sha", "key", "text").dropDuplicates(["sha"]))
    # texts of one key get each other's positions, which only adds candidates; from here on every text has a number of its own
    texts = cut_lineage(texts.join(ranked, "key").drop("key").withColumn("key", F.monotonically_increasing_id()), "candidate-texts")
    candidates = texts.select("key", "text", "shared")
    grams = candidates.mapInArrow(_common_grams(length), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = cut_lineage(grams.where(F.col("n") >= HOT_LEAST), "common-grams")
    total = candidates.count()
    hot = grams.where(F.col("n") >= F.lit(total * HOT_SHARE)).orderBy(F.desc("n"), "gram").limit(100_000).collect()
    hot = np.sort(np.array([r["gram"] for r in hot], dtype=np.int64).view(np.uint64))
    answers = (candidates.mapInArrow(_piece_rows(length, hot, buckets), "bucket int, key long, pos int, payload binary")
               .repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_sort_bucket(length), "key long, payload binary")
               .groupBy("key").agg(F.collect_list("payload").alias("ranges")))
    return texts, answers


def _results(texts: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            sha, text, ranges = (batch.column(i).to_pylist() for i in range(3))
            got = [_cut_out(t.encode(), r, length) for t, r in zip(text, ranges)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sha, pa.string()), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.int64()),
                 pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string())],
                names=["sha", "kept", "n_removed", "n_spans", "kept_sha256"])

    return texts.join(answers, "key").select("sha", "text", "ranges").mapInArrow(
        run, "sha string, kept binary, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, the remaining bytes' SHA-256, and the bytes if anything was removed."""
    texts, answers = repeated_suffixes(documents, length)
    done = _results(texts, answers, length)
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("raw")).select(
        "doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), F.sha2("raw", 256).alias("sha"))
    copied = docs.where(F.col("n_bytes") >= length).groupBy("sha").count().where("count > 1").select("sha", F.lit(True).alias("copied"))
    # one row per text that loses anything; a single join, whose hot texts adaptive execution can split
    lost = done.join(copied, "sha", "left_anti").withColumn("copied", F.lit(False))
    out = docs.join(lost.unionByName(copied, allowMissingColumns=True), "sha", "left")
    whole = F.coalesce(F.col("copied"), F.lit(False))
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(whole, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"))


def repeat_digests(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    return remove_repeats(documents, length).drop("kept")
