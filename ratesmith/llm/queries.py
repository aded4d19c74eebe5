"""The registered queries of this subpackage: one per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratesmith.llm import (
    bpe, decontaminate, jaccard, licences, lines, quality, search, secrets, spelling, suffixes, toxicity, urls, warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(_table(spark, sf_dir, "documents"))


def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(_table(spark, sf_dir, "documents"))


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def op7_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_digests(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_report(_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity_chain": op2_toxicity_chain,
    "op3_quality_rules": op3_quality_rules,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_bpe_encoding": op5_bpe_encoding,
    "op6_url_filter": op6_url_filter,
    "op7_fuzzy_line_dedup": op7_fuzzy_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_secret_scan": op9_secret_scan,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_ranked_search": op12_ranked_search,
    "op13_warc_archives": op13_warc_archives,
}

#: DuckDB SQL for the queries that SQL can express.  Like the queries, it reads whole tables.
ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": licences.duckdb_sql(),
    "op8_decontamination": r"""
WITH b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item FROM dw JOIN bw USING (k, win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""",
    "op11_spelling_variants": r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([CAST(b AS UBIGINT)] || list_transform(range(8), lambda k: CAST(0 AS UBIGINT)),
              lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) r(b)),
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
               unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[a-z\x{C0}-\x{FF}]+')) AS run
        FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, times,
         xor(CAST(4294967295 AS UBIGINT), list_reduce([CAST(4294967295 AS UBIGINT)] || flatten(list_transform(
               string_split(doc_id || ':' || run, ''),
               lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS UBIGINT)] ELSE [CAST(195 AS UBIGINT), CAST(ord(x) - 64 AS UBIGINT)] END)),
             lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) AS h
  FROM runs, crc_table),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                           ELSE run END AS word
        FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
shorter AS (
  SELECT word, n, k, left(word, k) || substr(word, k + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b USING (k, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS near_n, arg_min(other, (-n, encode(other))) AS near FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
chain AS (
  SELECT word, form AS root, 1 AS step FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM formed LEFT JOIN roots USING (word)
""",
    "op12_ranked_search": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
stats AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
asked AS (
  SELECT item_no, term, count(*) AS uses
  FROM (SELECT row_number() OVER () AS item_no,
               unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
        FROM benchmark) GROUP BY ALL),
items AS (SELECT item_id, row_number() OVER () AS item_no FROM benchmark),
postings AS (
  SELECT row_no, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_no, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, stats GROUP BY term, n_docs),
impacts AS (
  SELECT row_no, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // total))) AS part
  FROM postings JOIN weights USING (term), stats),
scores AS (
  SELECT item_no, row_no, doc_id, CAST(sum(uses * part) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY item_no, row_no, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (item_no) WHERE place <= 20
""",
    "op13_warc_archives": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS size FROM pages),
f AS (SELECT payload, min(page_id) AS first FROM p WHERE size >= 100 GROUP BY payload)
SELECT page_id, size AS payload_bytes, sha256(p.payload) AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload = f.payload AND size >= 100
""",
}
