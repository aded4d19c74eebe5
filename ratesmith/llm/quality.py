"""Quality rules: a hashed n-gram log-likelihood ratio with base rules (operator 3).

Words are runs of characters other than space and the ASCII controls 9-13.  Word
unigrams and bigrams are hashed into ``BUCKETS`` buckets; two multinomials over the
buckets are estimated with add-one smoothing: the *target* from trusted documents (the
labelled good ones whose id has an even hash) and the *raw* one from every document of
the corpus.  A document's score is the sum of log(target/raw) over its n-grams divided by
their number, and the verdict is the comparison of that score with one threshold, the same
for every document and set on all other labelled documents.  Every label takes part.

Defined cases: a null or empty text has no words, fails the base rules and scores 0;
repeated rows and null ids are judged row by row; without any trusted or any rejected
label the ratio is 0 for all and only the base rules decide; an empty table gives an
empty result.  Other columns of the input are ignored by :func:`quality_scores` and
carried unchanged by :func:`keep_good`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded
from ratesmith.session import cut_lineage

BUCKETS = 1 << 16
#: Labelled documents are picked out by a broadcast list of ids up to this many, by a shuffle beyond.
BROADCAST_IDS = 2_000_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Losing a good document costs as much as keeping this many bad ones (relative to their numbers).
LOSS_OF_GOOD = 20.0
SYMBOLS = b"#*$%&|<>"

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, llr double")


def _ngrams(data, start, end, row, rolling, values):
    """(bucket, row) of the unigrams and bigrams of a slice."""
    word = K.mix(rolling.load(values[data]).spans(start, end) ^ (end - start).astype(np.uint64))
    pair = K.windows(row, 2)
    two = K.mix(word[pair] * np.uint64(3) + word[pair + 1]) if len(pair) else word[:0]
    bucket = np.concatenate([word, two]) % np.uint64(BUCKETS)
    return word, bucket.astype(np.int64), np.concatenate([row, row[pair]])


def _counter():
    """Per-task counts of hashed n-grams: of all documents (raw) and of the trusted ones."""

    def run(batches):
        values, rolling = K.byte_values(), K.Rolling()
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = K.text_buffer(batch.column(0))
            trusted = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in K.slices(offsets):
                d, o = data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]
                start, end, row = K.runs(K.SPACED_WORD[d], o)
                _, bucket, owner = _ngrams(d, start, end, row, rolling, values)
                raw += np.bincount(bucket, minlength=BUCKETS)
                chosen = bucket[trusted[a:b][owner]]
                if len(chosen):
                    target += np.bincount(chosen, minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])],
                                         names=["bucket", "raw", "target"])

    return run


def judge(batch: pa.RecordBatch, ratio: np.ndarray, threshold: float, text_at: int) -> list[np.ndarray]:
    """The contract's columns (without the id) for one batch."""
    values, rolling, thirds = K.byte_values(), K.Rolling(), K.Rolling()
    data, offsets = K.text_buffer(batch.column(text_at))
    out = []
    symbol = K.byte_class(SYMBOLS, high=False)
    for a, b in K.slices(offsets):
        n = b - a
        d, o = data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]
        inside = K.SPACED_WORD[d]
        start, end, row = K.runs(inside, o)
        word, bucket, owner = _ngrams(d, start, end, row, rolling, values)
        score = np.bincount(owner, weights=ratio[bucket], minlength=n) / np.maximum(K.counts(owner, n), 1)
        # repeated three-word windows
        window = K.windows(row, 3)
        repeated = np.zeros(len(word), bool)
        if len(window):
            key = K.mix(thirds.load(word).spans(window, window + 3)) ^ K.mix(row[window].astype(np.uint64) + np.uint64(1))
            _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
            twice = window[times[inverse] > 1]
            for k in range(3):
                repeated[twice + k] = True
        # lines with a word that equal an earlier line of the text
        left, right, line_row = K.runs(d != 10, o)
        worded = np.searchsorted(start, left) < np.searchsorted(start, right)
        left, right, line_row = left[worded], right[worded], line_row[worded]
        key = K.mix(rolling.spans(left, right) ^ (right - left).astype(np.uint64)) ^ K.mix(line_row.astype(np.uint64) + np.uint64(1))
        _, first = np.unique(key, return_index=True)
        later = np.ones(len(key), bool)
        later[first] = False
        n_words, n_repeat = K.counts(row, n), K.counts(row[repeated], n)
        failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
        out.append([n_words, K.row_sums(inside & ((d & 0xC0) != 0x80), o), K.row_sums(symbol[d], o),
                    K.counts(line_row[later], n), n_repeat, failed, ~failed & (score >= threshold), score])
    if not out:
        return [np.empty(0, t) for t in (int, int, int, int, int, bool, bool, float)]
    return [np.concatenate(c) for c in zip(*out)]


class QualityModel:
    """The fitted ratio per bucket (a fixed-size table) and the threshold."""

    def __init__(self, ratio: np.ndarray, threshold: float):
        self.ratio, self.threshold = ratio, threshold


def labelled_parts(labels: DataFrame) -> DataFrame:
    """(doc_id, part) of every labelled document: ``trusted``, ``good`` or ``bad``.

    Trusted documents give the target counts; the good and bad ones only set the threshold,
    so that it is set on documents the target has not seen.  Ids labelled both ways are left out.
    """
    ids = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi"))
    even = F.xxhash64("doc_id").bitwiseAND(F.lit(1)) == 0
    part = F.when(F.col("lo") == 0, "bad").when(even, "trusted").otherwise("good")
    return ids.select("doc_id", part.alias("part"))


def threshold_of(good: np.ndarray, bad: np.ndarray, loss_of_good: float = LOSS_OF_GOOD) -> float:
    """The cut with the least loss; of a range of equally good ones, its middle.

    ``good`` and ``bad`` are rows (score in thousandths, number of documents).
    """
    cuts = np.arange(min(good[:, 0].min(), bad[:, 0].min()), max(good[:, 0].max(), bad[:, 0].max()) + 2)
    lost = np.array([good[good[:, 0] < c, 1].sum() for c in cuts]) / good[:, 1].sum()
    kept = np.array([bad[bad[:, 0] >= c, 1].sum() for c in cuts]) / bad[:, 1].sum()
    loss = loss_of_good * lost + kept
    best = np.flatnonzero(loss <= loss.min() + 1e-12)
    run = best[: 1 + int(np.argmax(np.append(np.diff(best) > 1, True)))]
    return float(cuts[run[len(run) // 2]]) / 1000


def fit(documents: DataFrame, labels: DataFrame) -> QualityModel:
    """Counts over the whole corpus, then the threshold from all labelled documents the target has not seen.

    What reaches the driver is bounded: ``BUCKETS`` counts and a histogram of scores.
    """
    parts = cut_lineage(labelled_parts(labels), "labelled-parts")
    sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    flat = QualityModel(np.zeros(BUCKETS), -np.inf)
    if len(sizes) < 3:
        return flat
    few = sum(sizes.values()) <= BROADCAST_IDS
    docs = bounded(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    trusted = parts.where("part = 'trusted'").select("doc_id", F.lit(True).alias("trusted"))
    total = (docs.join(F.broadcast(trusted) if few else trusted, "doc_id", "left")
             .select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
             .mapInArrow(_counter(), "bucket long, raw long, target long")
             .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    raw[total["bucket"]] += total["raw"]
    target[total["bucket"]] += total["target"]
    if target.sum() <= BUCKETS:
        return flat
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())

    def scored(batches):
        for batch in batches:
            got = judge(batch, ratio, -np.inf, 1)
            usable = pa.array(~got[5])  # the base rules decide the others
            cut = pa.array(np.floor(got[7] * 1000).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(usable), cut.filter(usable)], names=["doc_id", "cut"])

    held = parts.where("part <> 'trusted'").select("doc_id", (F.col("part") == "good").alias("good"))
    # beyond the bound every document is scored, and only ids and scores travel
    source = docs.join(F.broadcast(held.select("doc_id")), "doc_id", "left_semi") if few else docs
    seen = source.mapInArrow(scored, "doc_id long, cut long").join(held, "doc_id").groupBy("cut", "good").count().toPandas()
    sides = [seen.loc[seen["good"] == side, ["cut", "count"]].to_numpy() for side in (True, False)]
    if not all(map(len, sides)):
        return flat
    return QualityModel(ratio, threshold_of(*sides))


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base rules, score and verdict of every document (one row per input row)."""
    model = fit(documents, labels)
    ratio, threshold = model.ratio, model.threshold

    def run(batches):
        for batch in batches:
            got = judge(batch, ratio, threshold, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, got)],
                                             names=[c.split()[0] for c in SCHEMA.split(", ")])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    model = fit(documents, labels)
    ratio, threshold, at = model.ratio, model.threshold, documents.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(judge(batch, ratio, threshold, at)[6]))

    return documents.mapInArrow(run, documents.schema)
