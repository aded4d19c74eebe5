"""URL filters: rules by host and path, and a character language-model ratio (operator 6).

A rule (host, path) fits its host and all subdomains when the URL's path starts with the
rule's; the longest fitting rule wins.  URLs that no rule fits are judged by two variable-order
Markov models over characters (bytes), one of allowed and one of blocked URLs: contexts of
0 to ``ORDER`` characters, each order smoothed with the next shorter one by the number of
distinct followers (Witten-Bell).  The score is the difference of the two log-probabilities
per character; the threshold is calibrated on URLs whose hosts the scoring model has not seen.

Training covers every URL that a rule decides.  The models are tables of exact n-gram counts that
grow with the input and stay distributed: distinct texts are dealt into slabs, and a join brings each slab
the counts it needs.  What reaches the driver is which classes there are, and a histogram of scores.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule, and
is scored as the text it is; an empty text is scored by its end alone; repeated rows and null ids are judged row
by row; with allowed or blocked URLs missing, the rest is allowed with a score of 0; if a fold
of the hosts lacks a class there is nothing to calibrate on and the threshold is 0; a text of any length is
scored whole; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded
from ratesmith.llm.quality import threshold_of
from ratesmith.session import cut_lineage

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 4
FOLDS = 2
#: The folds that each model is counted from: one for each fold, and one for all.
MODELS = (*((f,) for f in range(FOLDS)), tuple(range(FOLDS)))
SLAB_BYTES = 1 << 20
START, END = b"\x02" * ORDER, b"\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER), F.regexp_extract(url, pattern, 2)


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for how, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(how)).otherwise(verdict)
    return rule, verdict


def judged_by_rules(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, ruled (verdict or null) and the text that the models read."""
    host, path = host_and_path(F.col("url"))
    out = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    rule, verdict = apply_rules(F.col("host"), F.col("path"))
    read = F.when(F.concat("host", "path") != "", F.concat("host", "path")).otherwise(F.coalesce("url", F.lit("")))
    return out.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), read.alias("read"))


def _grams(column: pa.Array, values, rolling):
    """Per order: (row, context hash, n-gram hash) of every character of the texts, its end included."""
    data, offsets = K.text_buffer(pa.array([START.decode() + t + END.decode() for t in column.to_pylist()], pa.large_string()))
    rolling.load(values[data])
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    at = np.arange(len(data))
    use = at - offsets[row] >= ORDER
    row, at = row[use], at[use]
    for k in range(ORDER + 1):
        # the order is part of the hash: contexts of different orders, and a context and an n-gram, are never one key
        yield row, K.mix(rolling.spans(at - k, at) ^ np.uint64(2 * k)), K.mix(rolling.spans(at - k, at + 1) ^ np.uint64(2 * k + 1))


def _count(batches):
    """Counts of (class, fold, context, n-gram), summed per slice."""
    values, rolling = K.byte_values(), K.Rolling()
    for batch in batches:
        side = np.array([2 * f + (r == "block") for r, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.int64)
        _, offsets = K.text_buffer(batch.column(2))
        for a, b in K.slices(offsets):
            for row, context, gram in _grams(batch.column(2).slice(a, b - a), values, rolling):
                cells = np.stack([side[a:b][row].astype(np.uint64), context, gram], axis=1)
                cells = cells[np.lexsort((cells[:, 2], cells[:, 0]))]
                new = np.concatenate([[True], (cells[1:, 0] != cells[:-1, 0]) | (cells[1:, 2] != cells[:-1, 2])])
                n = np.diff(np.append(np.flatnonzero(new), len(cells)))
                cells = cells[new].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cells[:, i]) for i in range(3)] + [pa.array(n)],
                                                 names=["side", "context", "gram", "n"])


def counted(known: DataFrame) -> DataFrame:
    """The models as one table (key, own, more): exact counts of the URLs (ruled, fold, read), by 64-bit key.

    The key of an n-gram has its count in ``own``; that of a context has its total in ``own`` and its number of
    distinct followers in ``more``; each is an array over ``MODELS`` and the classes allow, block.
    """
    exact = (known.mapInArrow(_count, "side long, context long, gram long, n long")
             .groupBy("context", "gram").agg(*[F.coalesce(F.sum(F.when(F.col("side").isin([2 * f + s for f in folds]), F.col("n"))), F.lit(0)).alias(f"n{m}{s}")
                                               for m, folds in enumerate(MODELS) for s in range(2)]))
    exact = cut_lineage(exact, "url-grams")
    cells = [f"n{m}{s}" for m in range(len(MODELS)) for s in range(2)]
    grams = exact.select(F.col("gram").alias("key"), F.array(*cells).alias("own"), F.array(*[F.lit(0).cast("long") for _ in cells]).alias("more"))
    contexts = exact.groupBy("context").agg(*[F.sum(c).alias(c) for c in cells], *[F.count(F.when(F.col(c) > 0, 1)).alias(f"k{c}") for c in cells])
    return grams.union(contexts.select("context", F.array(*cells), F.array(*[f"k{c}" for c in cells])))


def _needed(table: pa.Table) -> pa.Table:
    """The distinct keys that scoring the texts of a slab needs."""
    values, rolling = K.byte_values(), K.Rolling()
    found = [np.empty(0, np.uint64)]
    for _, context, gram in _grams(table.column("read").combine_chunks(), values, rolling):
        found += [np.unique(context), np.unique(gram)]
    key = np.unique(np.concatenate(found)).view(np.int64)
    return pa.table([pa.array(np.full(len(key), table.column("slab")[0].as_py(), np.int64)), pa.array(key)], names=["slab", "key"])


def _scored(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """(read, score of each model): the log-probability per character under the allowed model minus that under the blocked one."""
    column = texts.column("read").combine_chunks()
    key = counts.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    key, width = key[order], 2 * len(MODELS)
    own, more = (np.array(counts.column(c).to_pylist(), np.float64).reshape(-1, width)[order] for c in ("own", "more"))
    # what the models have not seen counts nothing: a last row of zeros
    own, more = np.vstack([own, np.zeros(width)]), np.vstack([more, np.zeros(width)])

    def place(keys):
        at = np.minimum(np.searchsorted(key, keys), max(len(key) - 1, 0))
        return np.where(key[at] == keys, at, len(key)) if len(key) else np.zeros(len(keys), np.int64)

    p, row = None, np.empty(0, np.int64)
    for row, context, gram in _grams(column, K.byte_values(), K.Rolling()):
        c, g = place(context), place(gram)
        p = np.full((len(row), width), 1 / 256) if p is None else p
        seen = own[c] + more[c]
        p = np.where(seen > 0, (own[g] + more[c] * p) / np.maximum(seen, 1), p)
    gain = np.log(p[:, 0::2]) - np.log(p[:, 1::2])
    size = np.bincount(row, minlength=len(column))
    score = [np.round(np.bincount(row, weights=gain[:, m], minlength=len(column)) / size, 9) for m in range(len(MODELS))]
    return pa.table([column, *[pa.array(x) for x in score]], names=["read", *[f"score{m}" for m in range(len(MODELS))]])


def scored_texts(ruled: DataFrame, models: DataFrame) -> DataFrame:
    """(read, score0, ...): each distinct text, scored by each of the models.

    Texts are dealt into slabs of about ``SLAB_BYTES``; each slab gets the counts its own characters
    need, by a join, so neither the models nor the texts are held as a whole anywhere.
    """
    texts = cut_lineage(ruled.select("read").distinct(), "url-texts")
    total = texts.agg(F.coalesce(F.sum(F.octet_length("read") + ORDER + 1), F.lit(0))).first()[0]
    slabs = max(1, -(-total // SLAB_BYTES))
    texts = texts.withColumn("slab", F.pmod(F.xxhash64("read"), F.lit(slabs)))
    needed = texts.groupBy("slab").applyInArrow(lambda t: _needed(t), "slab long, key long").join(models, "key")
    schema = "read string, " + ", ".join(f"score{m} double" for m in range(len(MODELS)))
    return texts.groupBy("slab").cogroup(needed.groupBy("slab")).applyInArrow(lambda t, c: _scored(t, c), schema)


def judge_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and the models' score of every page."""
    ruled = judged_by_rules(bounded(pages)).withColumn("page_id", F.col("page_id").cast("long"))
    known = ruled.where("ruled IS NOT NULL").select("ruled", F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int").alias("fold"), "read")
    trained = {(r.ruled, r.fold) for r in known.select("ruled", "fold").distinct().collect()}
    if len({how for how, _ in trained}) < 2:
        return ruled.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("llr"))
    # one row a distinct text, so that the pages of a very common one are split by the join that brings its score
    scores = cut_lineage(scored_texts(ruled, counted(known)), "url-scores")
    threshold = 0.0
    if len(trained) == 2 * FOLDS:
        # a URL is scored by the model of the other fold
        cut = F.floor(F.element_at(F.array(*[f"score{m}" for m in range(FOLDS)]), FOLDS - F.col("fold")) * 1000).cast("long")
        seen = known.join(scores, "read").groupBy(cut.alias("cut"), (F.col("ruled") == "allow").alias("good")).count().toPandas()
        threshold = threshold_of(*[seen.loc[seen["good"] == s, ["cut", "count"]].to_numpy() for s in (True, False)], loss_of_good=1.0)
    out = ruled.join(scores.select("read", F.col(f"score{FOLDS}").alias("llr")), "read", "left")
    verdict = F.coalesce("ruled", F.when(F.col("llr") >= threshold, "allow").otherwise("block"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "llr")
