"""Toxicity: a chain of linear classifiers (operator 2).

Categories are predicted in order.  Each has a logistic model over hashed words and word
beginnings; the probabilities of the earlier categories are extra inputs of the later ones.
A later model is trained on *out-of-fold* probabilities of the earlier categories (every
training row is scored by a model that has not seen its text), so it meets inputs as
uncertain as those of new documents.  The verdict's threshold is set on out-of-fold
probabilities too.

The models are fitted on the driver from at most ``TRAIN_ROWS`` labelled documents of each
value of ``toxic`` (the smallest ids by hash); every document of the corpus is scored whole.

Categories come from the labels' columns: ``low_quality`` (quality 0), ``toxic``, and
``toxic_low`` (both).  Defined cases: a null or empty text has only the models' constants and
is never called toxic; rows without a label, a text or an id do not train; an id labelled in
two ways does not train; with labels of one value only, every probability is 0 and no
document is toxic; repeated rows are scored row by row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded

FEATURES = 1 << 18
#: Bytes of word beginnings that are features beside the word itself.
BEGINNINGS = (5, 6, 7)
TRAIN_ROWS = 3_000
#: Features a category's model may use: those that separate its training rows most.
SELECTED = 128
FOLDS = 3
CATEGORIES = ("low_quality", "toxic", "toxic_low")
#: Calling a clean document toxic costs as much as missing this share of the toxic ones, relative to their numbers.
LOSS_OF_CLEAN = 5.0
WORD = K.ALNUM_WORD


def _features(data: np.ndarray, offsets: np.ndarray, values: np.ndarray, rolling: K.Rolling, wanted: np.ndarray | None = None):
    """(row, feature, value) of a slice; the value grows with the count and with its share of the row's words.

    ``wanted`` masks the features needed.
    """
    low = K.lower_ascii(data)
    start, end, row = K.runs(WORD[low], offsets)
    rolling.load(values[low])
    parts = [(row, K.mix(rolling.spans(start, end)))]
    for k in BEGINNINGS:
        long = end - start > k
        parts.append((row[long], K.mix(rolling.spans(start[long], start[long] + k) ^ np.uint64(k))))
    row, feature = np.concatenate([p[0] for p in parts]), (np.concatenate([p[1] for p in parts]) % np.uint64(FEATURES)).astype(np.int64)
    if wanted is not None:
        use = wanted[feature]
        row, feature = row[use], feature[use]
    words = K.counts(parts[0][0], len(offsets) - 1)
    cell, count = np.unique(row * FEATURES + feature, return_counts=True)
    row = cell // FEATURES
    return row, cell % FEATURES, (np.log1p(count) * np.log1p(200 * count / words[row])).astype(np.float32)


def _collect_features(ids: np.ndarray):
    def run(batches):
        values, rolling = K.byte_values(), K.Rolling()
        for batch in batches:
            known = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(np.isin(known, ids) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                                          & batch.column(1).is_valid().to_numpy(zero_copy_only=False)))
            data, offsets = K.text_buffer(batch.column(1))
            for a, b in K.slices(offsets):
                row, feature, value = _features(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], values, rolling)
                ends = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.array([feature[i:j].astype("<i4").tobytes() for i, j in zip(ends, ends[1:])], pa.binary()),
                     pa.array([value[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())], names=["doc_id", "features", "vals"])

    return run


class Linear:
    """A logistic model over selected features and the earlier probabilities."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, earlier: np.ndarray, constant: float):
        self.features, self.weights, self.earlier, self.constant = features, weights, earlier, constant


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Rows:
    """Sparse training rows."""

    def __init__(self, features: list[np.ndarray], values: list[np.ndarray]):
        self.size = np.array([len(f) for f in features])
        self.row = np.repeat(np.arange(len(features)), self.size)
        self.feature = np.concatenate(features).astype(np.int64)
        self.value = np.concatenate(values).astype(np.float64)

    def dense(self, chosen: np.ndarray) -> np.ndarray:
        at = np.full(FEATURES, -1)
        at[chosen] = np.arange(len(chosen))
        use = at[self.feature] >= 0
        out = np.zeros((len(self.size), len(chosen)))
        out[self.row[use], at[self.feature[use]]] = self.value[use]
        return out

    def select(self, label: np.ndarray, among: np.ndarray) -> np.ndarray:
        """The features whose presence separates the rows most (difference of shares, in standard errors)."""
        use = among[self.row]
        positive = use & label[self.row]
        n1, n0 = max(1, int((among & label).sum())), max(1, int((among & ~label).sum()))
        in1 = np.bincount(self.feature[positive], minlength=FEATURES)
        in0 = np.bincount(self.feature[use & ~label[self.row]], minlength=FEATURES)
        share = (in1 + in0 + 1) / (n1 + n0 + 2)
        z = np.abs(in1 / n1 - in0 / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
        z[in1 + in0 < 2] = 0
        order = np.lexsort((np.arange(FEATURES), -z))[:SELECTED]
        return np.sort(order[z[order] > 0])


def _train(rows: Rows, label: np.ndarray, earlier: np.ndarray, among: np.ndarray, l2: float = 1.0, steps: int = 40) -> Linear:
    """L2-regularised logistic regression; accelerated gradient steps, a fixed number, so the result is repeatable."""
    chosen = rows.select(label, among)
    x = np.hstack([rows.dense(chosen)[among], earlier[among], np.ones((int(among.sum()), 1))])
    y = label[among].astype(float)
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    scale = np.sqrt((x ** 2).mean(axis=0)) + 1e-6
    x = x / scale
    vector = np.ones(x.shape[1])
    for _ in range(20):  # largest curvature, by power iteration
        vector = x.T @ (x @ vector)
        norm = np.linalg.norm(vector)
        vector /= norm
    rate = 1 / (0.25 * weight.max() * norm + l2)
    w, ahead, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    for _ in range(steps * 10):
        slope = x.T @ (weight * (_sigmoid(x @ ahead) - y)) + l2 * ahead
        new = ahead - rate * slope
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    w = w / scale
    k = len(chosen)
    return Linear(chosen, w[:k], w[k:-1], float(w[-1]))


def _apply(model: Linear, rows: Rows, earlier: np.ndarray) -> np.ndarray:
    w = np.zeros(FEATURES)
    w[model.features] = model.weights
    z = np.bincount(rows.row, weights=w[rows.feature] * rows.value, minlength=len(rows.size))
    return _sigmoid(z + earlier @ model.earlier + model.constant)


class Chain:
    def __init__(self, models: dict[str, Linear], threshold: float):
        self.models, self.threshold = models, threshold


def train_chain(rows: Rows, labels: dict[str, np.ndarray], fold: np.ndarray) -> Chain:
    """Fits the categories in order; later ones see out-of-fold probabilities of the earlier."""
    n = len(fold)
    outside = np.zeros((n, 0))
    models, threshold = {}, 1.0
    for name in labels:
        label = labels[name]
        probability = np.zeros(n)
        for k in range(FOLDS):
            rest = fold != k
            if label[rest].any() and not label[rest].all():
                probability[~rest] = _apply(_train(rows, label, outside, rest), rows, outside)[~rest]
        if not label.any() or label.all():
            models[name] = Linear(np.empty(0, np.int64), np.empty(0), np.zeros(outside.shape[1]), -30.0)
        else:
            models[name] = _train(rows, label, outside, np.ones(n, bool))
        if name == "toxic" and label.any() and not label.all():
            cuts = np.linspace(0.02, 0.98, 97)
            loss = [LOSS_OF_CLEAN * (probability[~label] >= c).mean() + (probability[label] < c).mean() for c in cuts]
            best = np.flatnonzero(np.isclose(loss, min(loss)))
            run = best[: 1 + int(np.argmax(np.append(np.diff(best) > 1, True)))]
            threshold = float(cuts[run[len(run) // 2]])
        outside = np.hstack([outside, probability[:, None]])
    return Chain(models, threshold)


def fit(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Chain:
    """Trains the chain on a bounded sample of the labelled documents."""
    known = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1) AND toxic IN (0, 1)")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(*[f(c).alias(f"{n}_{c}") for c in ("quality", "toxic") for n, f in (("lo", F.min), ("hi", F.max))])
             .where("lo_quality = hi_quality AND lo_toxic = hi_toxic")
             .select("doc_id", F.col("lo_quality").alias("quality"), F.col("lo_toxic").alias("toxic"), F.xxhash64("doc_id").alias("h")))
    sample = [r for v in (0, 1) for r in known.where(F.col("toxic") == v).orderBy("h", "doc_id").limit(train_rows).collect()]
    empty = Linear(np.empty(0, np.int64), np.empty(0), np.zeros(0), -30.0)
    nothing = Chain({c: Linear(empty.features, empty.weights, np.zeros(i), -30.0) for i, c in enumerate(CATEGORIES)}, 1.0)
    if not sample:
        return nothing
    ids = np.array([r["doc_id"] for r in sample], dtype=np.int64)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.mapInArrow(_collect_features(ids), "doc_id long, features binary, vals binary")
    # one row an id, however often it is repeated: with the sample bounded, so is what the driver gets
    found = (found.groupBy("doc_id").agg(F.min(F.struct("features", "vals")).alias("row"))
             .select("doc_id", "row.features", "row.vals").orderBy("doc_id").toArrow())
    if not found.num_rows:
        return nothing
    by_id = {r["doc_id"]: r for r in sample}
    features = [np.frombuffer(x, "<i4") for x in found.column("features").to_pylist()]
    values = [np.frombuffer(x, np.float32) for x in found.column("vals").to_pylist()]
    chosen = [by_id[i] for i in found.column("doc_id").to_pylist()]
    low, toxic = (np.array([r[c] for r in chosen]) == v for c, v in (("quality", 0), ("toxic", 1)))
    # equal texts fall into one fold
    fold = np.array([int(K.mix(np.array([f.sum() + 7 * len(f)], np.uint64))[0] % np.uint64(FOLDS)) for f in features])
    if not toxic.any() or toxic.all():
        return nothing
    return train_chain(Rows(features, values), {"low_quality": low, "toxic": toxic, "toxic_low": low & toxic}, fold)


def toxicity_scores(documents: DataFrame, labels: DataFrame, chain: Chain | None = None) -> DataFrame:
    """Per row: doc_id, a probability per category, and whether the document is toxic."""
    chain = chain or fit(documents, labels)
    names, threshold = list(chain.models), chain.threshold
    table = np.zeros((len(names), FEATURES), np.float32)
    for i, name in enumerate(names):
        table[i, chain.models[name].features] = chain.models[name].weights
    heads = [(chain.models[name].earlier, chain.models[name].constant) for name in names]
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(table)

    def run(batches):
        weights = shared.value
        wanted = (weights != 0).any(axis=0)
        values, rolling = K.byte_values(), K.Rolling()
        for batch in batches:
            data, offsets = K.text_buffer(batch.column(1))
            got = np.zeros((batch.num_rows, len(names)))
            for a, b in K.slices(offsets):
                row, feature, value = _features(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], values, rolling, wanted)
                for i, (earlier, constant) in enumerate(heads):
                    z = np.bincount(row, weights=weights[i, feature].astype(np.float64) * value, minlength=b - a) + constant
                    got[a:b, i] = _sigmoid(z + got[a:b, :i] @ earlier[:i])
            some = np.diff(offsets) > 0
            toxic = some & (got[:, names.index("toxic")] >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.round(got[:, i], 6)) for i in range(len(names))], pa.array(toxic)],
                                             names=["doc_id", *[f"p_{n}" for n in names], "toxic"])

    schema = "doc_id long, " + ", ".join(f"p_{n} double" for n in names) + ", toxic boolean"
    return bounded(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
