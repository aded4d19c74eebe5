"""Benchmark decontamination: a broadcast set of test n-grams scanned over token windows (operator 8).

Texts are lower-cased (A-Z) and cut into words of digits, ASCII letters and non-ASCII
characters.  A benchmark item gives its windows of ``WINDOW`` consecutive words, or one
window of all its words if it has fewer.  The hashed windows are broadcast in blocks of about
``BLOCK_WINDOWS`` (window, item) rows; every document's windows are looked up, each hit is verified
word by word, and hit words are united over the blocks.  A benchmark of any size is served:
more blocks mean more passes, which read the texts and keep only the hits, not more memory.

Defined cases: null and empty texts have no words and no hits; an item without words gives
no window, an item with a null id counts as the item with the empty name; repeated rows are
judged row by row; an empty benchmark gives no hits; other columns are carried unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded
from ratesmith.session import cut_lineage

WINDOW = 13
#: Rows (window, item) of one broadcast: about 150 bytes each with their words.
BLOCK_WINDOWS = 200_000
#: A document is contaminated when at least one word in this many is hit.
ONE_WORD_IN = 20
HITS, ITEMS, WORDS = "__hit_words", "__hit_items", "__n_words"


def _tokens(data, offsets, values, rolling):
    """Lower-cased bytes, word starts, ends and rows, and word hashes of a slice."""
    data = K.lower_ascii(data)
    start, end, row = K.runs(K.ALNUM_WORD[data], offsets)
    return data, start, end, row, K.mix(rolling.load(values[data]).spans(start, end) ^ (end - start).astype(np.uint64))


def _window_hashes(rolling: K.Rolling, at: np.ndarray, k: int) -> np.ndarray:
    return K.mix(rolling.spans(at, at + k) ^ np.uint64(k))


def _spelled(data, start, end, i: int, k: int) -> bytes:
    return b" ".join(data[start[j]: end[j]].tobytes() for j in range(i, i + k))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, n, hash, words): every distinct window of every item."""

    def run(batches):
        values, rolling, over = K.byte_values(), K.Rolling(), K.Rolling()
        for batch in batches:
            data, offsets = K.text_buffer(batch.column(1))
            item = batch.column(0).to_pylist()
            rows = []
            for a, b in K.slices(offsets):
                d, start, end, row, word = _tokens(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], values, rolling)
                over.load(word)
                size = K.counts(row, b - a)
                first = np.concatenate([[0], np.cumsum(size)])
                for r in np.flatnonzero(size):
                    k = min(window, int(size[r]))
                    at = np.arange(first[r], first[r] + size[r] - k + 1)
                    for i, h in zip(at, _window_hashes(over, at, k).view(np.int64)):
                        rows.append((item[a + r], k, int(h), _spelled(d, start, end, i, k)))
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["item", "n", "hash", "words"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return items.mapInArrow(run, "item string, n int, hash long, words binary").distinct()


class _Finder:
    """Finds the windows of one block in slices of documents."""

    def __init__(self, by_window: dict[tuple[int, int], dict[bytes, list[str]]], lengths: dict[int, np.ndarray]):
        self.by_window, self.tables = by_window, lengths
        self.filters = {}
        for k, table in lengths.items():
            self.filters[k] = np.zeros(1 << 20, bool)
            self.filters[k][(table & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.values, self.rolling, self.over = K.byte_values(), K.Rolling(), K.Rolling()

    def find(self, column: pa.Array) -> tuple[np.ndarray, dict[int, list[int]], dict[int, set[str]]]:
        """(words per row, hit [start, end) pairs and items by row, of the rows that have any)."""
        data, offsets = K.text_buffer(column)
        total, hits, items = np.zeros(len(column), np.int64), {}, {}
        for a, b in K.slices(offsets):
            d, start, end, row, word = _tokens(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], self.values, self.rolling)
            self.over.load(word)
            size = K.counts(row, b - a)
            total[a:b] = size
            first = np.concatenate([[0], np.cumsum(size)])
            for k, table in self.tables.items():
                at = K.windows(row, k)
                h = _window_hashes(self.over, at, k)
                maybe = np.flatnonzero(self.filters[k][(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
                slot = np.minimum(np.searchsorted(table, h[maybe]), len(table) - 1)
                for i in maybe[table[slot] == h[maybe]]:
                    found = self.by_window[k, int(h[i].view(np.int64))].get(_spelled(d, start, end, at[i], k))
                    if found:
                        r = int(row[at[i]])
                        where = int(at[i] - first[r])
                        hits.setdefault(a + r, []).extend((where, where + k))
                        items.setdefault(a + r, set()).update(found)
        return total, hits, items


def _block(spark, windows: list):
    """A block of (item, n, hash, words) rows as a broadcast that tasks make their finder from."""
    by_window: dict[tuple[int, int], dict[bytes, list[str]]] = {}
    for item, n, h, words in windows:
        by_window.setdefault((n, h), {}).setdefault(bytes(words), []).append(item)
    lengths = {n: np.sort(np.array([h for m, h in by_window if m == n], dtype=np.int64).view(np.uint64))
               for n in sorted({n for n, _ in by_window})}
    return spark.sparkContext.broadcast((by_window, lengths))


def _marked(df: DataFrame, block) -> DataFrame:
    """One pass with the only block: the rows with their words, hits and items."""
    text_at, words_at, hits_at, items_at = (df.columns.index(c) for c in ("text", WORDS, HITS, ITEMS))

    def run(batches):
        finder = _Finder(*block.value)
        for batch in batches:
            total, hits, items = finder.find(batch.column(text_at))
            columns = list(batch.columns)
            columns[words_at] = pa.array(total)
            columns[hits_at] = pa.array([_united(hits.get(r)) for r in range(batch.num_rows)], pa.list_(pa.int32()))
            columns[items_at] = pa.array([sorted(items.get(r, ())) for r in range(batch.num_rows)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def _hits_of_block(texts: DataFrame, block) -> DataFrame:
    """(sha, hits, items) of the texts that have any: what a pass of several keeps."""

    def run(batches):
        finder = _Finder(*block.value)
        for batch in batches:
            _, hits, items = finder.find(batch.column(1))
            at = sorted(hits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array([_united(hits[r]) for r in at], pa.list_(pa.int32())),
                 pa.array([sorted(items[r]) for r in at], pa.list_(pa.string()))], names=["sha", "hits", "items"])

    return texts.mapInArrow(run, "sha string, hits array<int>, items array<string>").dropDuplicates(["sha"])


def _united(flat: list[int] | None) -> list[int]:
    """Disjoint, ordered [start, end) pairs that cover the same words, as a flat list."""
    out: list[int] = []
    pairs = sorted(zip(flat[::2], flat[1::2])) if flat else []
    for start, end in pairs:
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _count_and_unite(df: DataFrame) -> DataFrame:
    """Fills in the words of each row and unites the hits gathered from several blocks."""
    text_at, words_at, hits_at = (df.columns.index(c) for c in ("text", WORDS, HITS))

    def run(batches):
        values, rolling = K.byte_values(), K.Rolling()
        for batch in batches:
            data, offsets = K.text_buffer(batch.column(text_at))
            total = np.zeros(batch.num_rows, np.int64)
            for a, b in K.slices(offsets):
                _, _, _, row, _ = _tokens(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], values, rolling)
                total[a:b] = K.counts(row, b - a)
            columns = list(batch.columns)
            columns[words_at] = pa.array(total)
            columns[hits_at] = pa.array([_united(x) for x in batch.column(hits_at).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def mark_hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
              block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents with their number of words, hit words ([start, end) pairs, flat) and hit items."""
    spark = documents.sparkSession
    windows = cut_lineage(benchmark_windows(benchmark, window), "benchmark-windows")
    blocks = max(1, -(-windows.count() // block_windows))
    documents = bounded(documents)
    empty = {WORDS: F.lit(0).cast("long"), HITS: F.lit(None).cast("array<int>"), ITEMS: F.lit(None).cast("array<string>")}
    if blocks == 1:
        return _marked(documents.withColumns(empty), _block(spark, [tuple(r) for r in windows.collect()]))
    # rows are dealt by window and item, so a window that many items share does not fill one block
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    texts, found = documents.select(sha.alias("sha"), "text"), []
    for k in range(blocks):
        block = windows.where(F.pmod(F.xxhash64("hash", "item"), F.lit(blocks)) == k).collect()
        found.append(cut_lineage(_hits_of_block(texts, _block(spark, [tuple(r) for r in block])), "block-hits"))
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    hits = hits.groupBy("sha").agg(F.flatten(F.collect_list("hits")).alias(HITS), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias(ITEMS))
    none = F.array()
    out = (documents.withColumn("__sha", sha).join(hits.withColumnRenamed("sha", "__sha"), "__sha", "left")
           .withColumns({WORDS: F.lit(0).cast("long"), HITS: F.coalesce(HITS, none.cast("array<int>")),
                         ITEMS: F.coalesce(ITEMS, none.cast("array<string>"))}))
    return _count_and_unite(out.select(*documents.columns, WORDS, HITS, ITEMS))


def _n_hit():
    pairs = F.transform(F.col(HITS), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda s, x: s + x)


def _contaminated():
    return (F.size(HITS) > 0) & (ONE_WORD_IN * _n_hit() >= F.col(WORDS))


def decontamination_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, items, and whether it counts as contaminated."""
    marked = mark_hits(documents.select("doc_id", "text"), benchmark)
    return marked.select(
        "doc_id", F.col(WORDS).alias("n_words"), _n_hit().alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ITEMS), ",").cast("binary"), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return mark_hits(documents, benchmark).where(~_contaminated()).select(*documents.columns)


def remove_spans(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents, with the text between the first and last character of each hit run of words cut out."""
    marked = mark_hits(documents, benchmark)
    text_at, hits_at = marked.columns.index("text"), marked.columns.index(HITS)

    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for r, flat in enumerate(batch.column(hits_at).to_pylist()):
                if not flat:
                    continue
                raw = texts[r].encode()
                d = K.lower_ascii(np.frombuffer(raw, np.uint8))
                start, end, _ = K.runs(K.ALNUM_WORD[d], np.array([0, len(d)]))
                kept, at = [], 0
                for i, j in zip(flat[::2], flat[1::2]):
                    kept.append(raw[at: start[i]])
                    at = end[j - 1]
                texts[r] = (b"".join(kept) + raw[at:]).decode()
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return marked.mapInArrow(run, marked.schema).select(*documents.columns)
