"""Spelling variants, ranked search and WARC archives against brute force and round trips."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from ratesmith.llm import search, spelling, warc


def table(spark, rows):
    """Documents with two columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, "b", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


# ---- 11: spelling variants -----------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def expected_groups(counts):
    near = collections.defaultdict(list)
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x))
        if counts[best] >= 10 * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def altered(rows):
    counts = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return counts


def groups(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_checksums_are_crc32():
    rnd = random.Random(1)
    spans = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 2, 9, 63, 64, 65, 300]))) for _ in range(200)]
    end = np.cumsum([len(s) for s in spans])
    start = end - [len(s) for s in spans]
    begun = np.array([zlib.crc32(b"%d:" % i) for i in range(200)], np.uint32)
    got = spelling.checksums(np.frombuffer(b"".join(spans), np.uint8), start, end, begun, spelling._crc_table())
    assert got.tolist() == [zlib.crc32(b"%d:" % i + s) for i, s in enumerate(spans)]


def test_spelling_variants_against_brute_force(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcß×é") for _ in range(rnd.randint(6, 9))) for _ in range(150)]
    common = [w for w in words if len(w) >= 7][:20]
    rows = [(0, None), (1, ""), (2, " \n7 !"), (None, "Worthwhile WORTHWHILE worthwhile"), (3, "same same sameness sameness"), (3, "same same sameness sameness"),
            (4, "x" * 5000 + " " + "x" * 5000 + " " + "x" * 5001 + " " + "x" * 5001), (5, "日本語abcdefgh日abcdefgh Ünïcödé Ünïcödé")]
    rows += [(10 + i, " ".join(rnd.choice(words if rnd.random() < 0.5 else common).capitalize() for _ in range(rnd.randint(0, 120)))) for i in range(150)]
    rows += [(500 + i, " ".join(common * 3)) for i in range(40)]
    counts = altered(rows)
    got = table(spark, rows)
    assert {tuple(r) for r in spelling.altered_words(got).collect()} == set(counts.items())
    want = expected_groups({w: n for w, n in counts.items() if n >= 2})
    assert groups(spelling.spelling_report(got)) == want
    assert sum(r[1] is not None for r in want) > 20
    assert spelling.spelling_report(got.where("false")).count() == 0


def test_one_bucket_of_many_words(spark, monkeypatch):
    """Words that all begin (or end) alike are halved down, on Spark and in tasks; the pairs stay the same."""
    rnd = random.Random(4)
    words = {p + "".join(rnd.choice("ab") for _ in range(rnd.randint(5, 8))) + s for p, s in (("commonprefix", ""), ("", "commonsuffix")) for _ in range(250)}
    counts = {w: rnd.choice([1, 2, 15, 40, 400]) for w in words} | {"aaaaaaa": 10 ** 12, "aaaaaab": 10 ** 11, "aaaaabb": 10 ** 9}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("bucket", F.lit(1))
    want = expected_groups(counts)
    assert max(r[4] for r in want) > 5
    assert any(r[1] is not None and r[2] != r[1] for r in want)  # a chain of forms
    assert groups(spelling.variant_groups(df)) == want
    monkeypatch.setattr(spelling, "BUCKET", 20)  # halved on Spark already
    monkeypatch.setattr(spelling, "TILE", 4)
    assert groups(spelling.variant_groups(df)) == want


def test_words_beyond_one_byte(spark):
    counts = {"\U0001f600bcdefg": 50, "\U0001f601bcdefg": 2, "日本語日本語日": 30, "日本語日本語日日": 3, "alone word": 1, "ab": 9, "b": 90, "": 1000}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert groups(spelling.variant_groups(df)) == expected_groups(counts)


# ---- 12: ranked search ---------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def expected_ranks(docs, items, k=20):
    bags = [(i, collections.Counter(TERM.findall(lower(t)))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    total = sum(n for *_, n in bags)
    df = collections.Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        asked, scored = TERM.findall(lower(text)), []
        for i, c, n in bags:
            m = 75 + (25 * n * len(bags)) // total
            score = sum(math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in asked if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -score) for r, (score, none, i) in enumerate(sorted(scored)[:k])]
    return collections.Counter(out)


def queries_of(spark, items):
    return spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, score string").repartition(2)


def search_rows():
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ünï", "9", "42", "日本"]
    text = lambda n: rnd.choice([" ", "-", ". "]).join(rnd.choice(vocabulary[:int(5 + 60 * rnd.random())]) for _ in range(n))
    docs = [(0, None), (1, ""), (2, "!? _ ["), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (3, "w1 W2 w3"), (3, "w1 w2 w3"), (4, "w1 " * 40_000)]
    docs += [(10 + i, text(rnd.randint(1, 60))) for i in range(200)]
    phrase = text(12)
    items = [(0, None), (1, ""), (2, "..."), (3, "w1"), (3, "w1"), (4, "w1 w1 W1 w2"), (5, "nowhere to be found"), (None, "été 42"), (6, text(300))]
    items += [(20 + i, phrase + " " + text(rnd.randint(1, 15))) for i in range(25)]
    return docs, items


def test_ranked_search_against_brute_force(spark):
    docs, items = search_rows()
    want = expected_ranks(docs, items)
    got = search.rank_documents(table(spark, docs), queries_of(spark, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert collections.Counter(map(tuple, got.collect())) == want
    few = search.rank_documents(table(spark, docs), queries_of(spark, items), k=3, block_terms=60)  # many blocks
    assert collections.Counter(map(tuple, few.collect())) == expected_ranks(docs, items, 3)
    assert search.rank_documents(table(spark, docs).where("false"), queries_of(spark, items)).count() == 0
    assert search.rank_documents(table(spark, docs), queries_of(spark, items).where("false")).count() == 0


def test_shared_sums(spark):
    rnd = random.Random(7)
    stock = [rnd.sample(range(40), 6) for _ in range(5)]
    queries = [collections.Counter(rnd.choice(stock) + rnd.choice(stock) + rnd.choices(range(40), k=rnd.choice([1, 5, 200]))) for _ in range(30)]
    pairs, roots = search.mine_shared_sums(queries, 40)
    value = [rnd.randint(0, 10 ** 6) for _ in range(40)]
    for a, b in pairs:
        value.append(value[a] + value[b])
    assert [value[r] for r in roots] == [sum(value[t] * c for t, c in q.items()) for q in queries]
    assert len(pairs) < sum(sum(q.values()) - 1 for q in queries)  # fewer additions than query by query
    at = {n: d for d, (nodes, *_) in enumerate(search.levels(40, pairs)) for n in nodes}
    assert all(max(at.get(a, -1), at.get(b, -1)) < at[40 + i] for i, (a, b) in enumerate(pairs))
    same = search.mine_shared_sums([collections.Counter({0: 1, 1: 2, 2: 1})] * 4, 3)
    assert len(same[0]) == 3 and len(set(same[1])) == 1  # equal queries cost one


# ---- 13: WARC archives ---------------------------------------------------------------------

def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "d") for i, u, h in rows], "page_id long, url string, html string, digest string").repartition(3)


def expected_pages(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        raw, to = (h or "").encode(), first.get(h)
        again = to is not None and i != to
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", to if again else None))
    return collections.Counter(out)


def page_rows():
    rnd = random.Random(8)
    page = lambda n: "<html><body>" + " ".join(rnd.choice("alpha beta gamma déjà 日本 <p> </p>".split()) + str(rnd.randint(0, 99)) for _ in range(n)) + "</body></html>"
    twin, triple = page(40), page(200)
    rows = [(0, None, None), (1, "", ""), (2, "http://a b/\r\nWARC-Type: x", "x" * 99), (3, "u", "x" * 99), (9, "http://x/ü", twin), (4, "http://x", twin),
            (None, "n", triple), (5, "t", triple), (6, "t", triple), (5, "t", triple), (None, "alone", page(50)), (None, "both", "z" * 100), (None, "both", "z" * 100),
            (7, "crlf", "\r\n\r\n" * 60), (8, "long", "ab\n" * 2_000_000)]
    return rows + [(100 + i, f"http://h/{i}", page(rnd.randint(1, 80))) for i in range(120)] + [(300 + i, "again", twin) for i in range(60)]


def test_warc_report_and_round_trip(spark, scratch):
    rows = page_rows()
    got = warc.archive_report(pages_of(spark, rows))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert collections.Counter(map(tuple, got.collect())) == expected_pages(rows)
    warc.write_archives(pages_of(spark, rows), f"{scratch}/a", archive_bytes=20_000)
    back = warc.read_archives(spark, f"{scratch}/a", with_payload=True).collect()
    assert len({r.archive for r in back}) > 3
    payload = collections.Counter((r.page_id, r.url, bytes(r.payload)) for r in back if r.record_type == "response")
    want = {(i if i is None else str(i), warc._encoded(u), (h or "").encode()) for i, u, h in rows}
    assert set(payload) <= want and {p for *_, p in payload} == {p for *_, p in want}
    assert warc.archive_report(pages_of(spark, rows).where("false")).count() == 0


def test_more_repeats_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    rows = page_rows()
    assert collections.Counter(map(tuple, warc.archive_report(pages_of(spark, rows)).collect())) == expected_pages(rows)


def test_archive_layout(spark, scratch):
    """Dictionary in a leading skippable frame, one frame a record, readable as one stream and record by record."""
    rows = [r for r in page_rows() if r[0] != 8]
    warc.write_archives(pages_of(spark, rows).coalesce(1), f"{scratch}/a")
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(f"{scratch}/a").collect()]
    assert len(files) == 1
    [archive] = files
    assert archive[:4] == bytes([0x5D, 0x2A, 0x4D, 0x18]) and archive.endswith(warc.PADDING_FRAME.encode())
    dictionary, at = warc.archive_dictionary(archive)
    assert dictionary.dict_id() and at > 100
    frames = list(warc.record_frames(archive))
    assert len(frames) == len(rows) + 1 and frames[0][0] == at and warc.parse_record(frames[0][2])[0]["WARC-Type"] == "warcinfo"
    for offset, length, record in frames:
        assert zstandard.get_frame_parameters(archive[offset:offset + length]).dict_id == dictionary.dict_id()
        assert warc.read_record(archive, offset, length) == record
    stream = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(archive, read_across_frames=True).read()
    assert stream == b"".join(record for *_, record in frames)
    plain = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(record)) for *_, record in frames)
    assert sum(length for _, length, _ in frames) < 0.9 * plain  # what the dictionary is for


@pytest.mark.parametrize("damage", [lambda a: a[:-30], lambda a: a[:len(a) // 2] + b"\0" + a[len(a) // 2 + 1:]])
def test_damaged_archives_do_not_pass(damage):
    records = [warc.page_record(str(i), "u", b"payload %d" % i * 40, len(b"payload %d" % i * 40), "0", None, "d") for i in range(50)]
    archive = warc.build_archive(records, "d")
    assert [r for *_, r in warc.record_frames(archive)][1:] == records
    with pytest.raises((ValueError, zstandard.ZstdError)):
        assert [r for *_, r in warc.record_frames(damage(archive))][1:] == records or None
        raise ValueError("records differ")


def test_wrong_digest_is_an_error(spark, scratch):
    record = warc.page_record("1", "u", b"payload", 7, hashlib.sha256(b"other").hexdigest(), None, "d")
    df = spark.createDataFrame([(bytearray(warc.build_archive([record], "d")),)], "archive binary")
    df.select(F.col("archive").cast("string").alias("value")).write.option("lineSep", warc.PADDING_FRAME).text(f"{scratch}/a")
    with pytest.raises(Exception, match="not the one its header states"):
        warc.read_archives(spark, f"{scratch}/a").collect()
