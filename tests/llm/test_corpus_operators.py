"""Operators that compare documents with each other, against brute force on small tables."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from ratesmith.llm import graph, jaccard, kernels as K, lines, suffixes

SPACED = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, sig string, n int, x long"  # the last three clash with names used inside


def table(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], SCHEMA).repartition(3)


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_connected_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5000, 5000), (2000, 2001), (2001, 2000)]
    edges += [(rnd.randint(3000, 3300), rnd.randint(3000, 3300)) for _ in range(200)]
    rnd.shuffle(edges)
    u = Union({v for e in edges for v in e})
    for a, b in edges:
        u.join(a, b)
    want = {v: u.find(v) for a, b in edges if a != b for v in (a, b)}
    got = graph.connected_components(spark.createDataFrame(edges, "p long, q long")).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert graph.connected_components(spark.createDataFrame([], "p long, q long")).count() == 0


@pytest.mark.parametrize("edges, rounds", [
    ([], 0),
    ([(7, 7), (None, 3), (3, None)], 0),
    ([(5, 1), (1, 5), (1, 6), (6, 1), (9, 8), (8, 9)], 0),
    ([(1, 3), (2, 3)], 1),
    ([(1, 2), (2, 3)], 1),
    ([(1, 5), (2, 5), (2, 6), (6, 7), (8, 9)], 2),
])
def test_components_take_no_round_on_stars(spark, monkeypatch, edges, rounds):
    """Each round costs the driver plans, stages and tasks: none runs on stars, and none after they are reached."""
    ran, once = [], graph._round
    monkeypatch.setattr(graph, "_round", lambda e: ran.append(1) or once(e))
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    u = Union({v for e in real for v in e})
    for a, b in real:
        u.join(a, b)
    got = graph.connected_components(spark.createDataFrame(edges, "p long, q long")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((v, u.find(v)) for v in u.up)
    assert len(ran) == rounds



# ---- 4: Jaccard join -----------------------------------------------------------------------

def shingles(text):
    words = re.findall(SPACED, (text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def linked_groups(rows):
    sets = [shingles(t) for _, t in rows]
    u = Union(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                u.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if sets[i] and doc is not None:
            r = u.find(i)
            least[r] = min(least.get(r, doc), doc)
    return collections.Counter((doc, len(sets[i]), least.get(u.find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows))


def near_copies(rnd, n, base, changed):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, changed)):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(1000)}"
        out.append(" ".join(words))
    return out


def test_jaccard_groups_against_brute_force(spark):
    rnd = random.Random(2)
    texts = [None, "", " \n", "one", "One", "two words", "a b c d e", "A b\tc D e", "long " * 30_000]
    for size in (9, 14, 22, 60, 150):  # light sets, the boundary, heavy sets
        base = [f"v{size}_{i}" for i in range(size)]
        texts += near_copies(rnd, 25, base, max(1, size // 30)) + [" ".join(base[:k]) for k in range(size - 6, size + 1)]
    passage = [f"p{i}" for i in range(40)]  # many documents share a passage and nothing else
    texts += [" ".join([f"u{d}_{i}" for i in range(20)] + passage + [f"t{d}_{i}" for i in range(20)]) for d in range(30)]
    chain = [f"c{i}" for i in range(120)]  # each links with the next only
    texts += [" ".join(chain[k:k + 60]) for k in range(0, 60, 5)]
    rows = list(enumerate(texts)) + [(10_000, texts[40]), (10_000, texts[40]), (None, texts[60]), (None, None)]
    docs = table(spark, rows)
    got = collections.Counter(tuple(r) for r in jaccard.similar_groups(docs).collect())
    assert got == linked_groups(rows)


def test_jaccard_on_empty_tables_and_as_a_filter(spark):
    docs = table(spark, [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (5, "other words in this one text")])
    kept = jaccard.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
    assert jaccard.similar_groups(docs.where("false")).count() == 0


def test_boundary_follows_the_cost():
    assert jaccard.choose_boundary({}) == 0
    assert jaccard.choose_boundary({8: 1000}) == 10  # the least size that keeps sets of 8 off the lists
    s = jaccard.choose_boundary({n: 100 for n in range(1, 31)})
    assert 5 <= s <= 12 and jaccard.subset_count(24) > 1000
    for a in range(1, 60):
        for b in range(a, 60):
            need = jaccard.overlap_needed(a, b)
            assert 100 * need >= 80 * (a + b - need) and 100 * (need - 1) < 80 * (a + b - need + 1)


def test_linked_sets_share_enough_of_their_prefixes():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        a = rnd.choice(2000, rnd.integers(1, 120), replace=False)
        b = np.unique(np.concatenate([a[: len(a) - rnd.integers(0, len(a) // 8 + 1)], rnd.choice(2000, rnd.integers(0, 6))]))
        inter = len(np.intersect1d(a, b))
        if 100 * inter < 80 * (len(a) + len(b) - inter):
            continue
        cut = [set(np.sort(s)[: int(jaccard.prefix_size(len(s)))]) for s in (a, b)]
        assert len(cut[0] & cut[1]) >= max(int(jaccard.prefix_shared(len(a))), int(jaccard.prefix_shared(len(b))))


# ---- 7: line dedup -------------------------------------------------------------------------

def plain(line):
    return " ".join(re.findall("[0-9a-z\x80-\U0010ffff]+", line.translate(LOWER)))


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_edit_distance():
    rnd = random.Random(4)
    for _ in range(1500):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 14))) for _ in range(2))
        assert lines.edit_distance(a, b) == levenshtein(a, b)
        longer = max(len(a), len(b))
        assert lines.similar(a, b) == (5 * levenshtein(a, b) <= longer)


def test_word_scripts_are_never_shorter_than_the_distance():
    rnd = random.Random(14)
    accepted = 0
    for _ in range(2000):
        left = [rnd.choice(["a", "bb", "ccc", "dddd", "é"]) for _ in range(rnd.randint(1, 12))]
        right = list(left)
        for _ in range(rnd.randint(0, 4)):
            i, kind = rnd.randrange(len(right)), rnd.random()
            if kind < 0.3 and len(right) > 1:
                del right[i]
            elif kind < 0.6:
                right.insert(i, rnd.choice(["x", "yy", "bb"]))
            else:
                right[i] = rnd.choice(["x", "a", "ccc"])
        distance = levenshtein(" ".join(left), " ".join(right))
        assert not any(lines._words_within(left, right, allowed) for allowed in range(distance))
        accepted += lines._words_within(left, right, distance)
    assert accepted > 1000


def test_blocks_ask_about_every_similar_pair():
    rnd = random.Random(15)
    dropped = 0
    for _ in range(60):
        base = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé ") for _ in range(rnd.randint(1, 60))) for _ in range(6)]
        items = []
        for _ in range(30):
            x = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 8)):
                x.insert(rnd.randint(0, len(x)), "q") if rnd.random() < 0.6 or len(x) < 2 else x.pop(rnd.randrange(len(x)))
            items.append("".join(x))
        left, right = np.nonzero(np.triu(np.ones((30, 30), bool), 1))
        likely = lines._may_be_similar(items, left, right)
        dropped += int((~likely).sum())
        assert all(k or not lines.similar(items[i], items[j]) for i, j, k in zip(left, right, likely))
    assert dropped > 10_000
    none = np.empty(0, np.int64)
    assert len(lines._may_be_similar([], none, none)) == 0


def test_lines_are_cut_out_and_picked_out_like_split_lines():
    import pyarrow as pa

    rnd = random.Random(16)
    cut, gone_type = lines._apply(1, 2), pa.list_(pa.struct([("line", pa.int32()), ("sig", pa.binary())]))
    reader = lines.LineReader()

    def signatures(text):
        read = reader.read(*lines.K.text_buffer(pa.array([text], pa.string())))
        return {int(k): pair.tobytes() for k, pair in zip(read[5], read[8])}

    for _ in range(300):
        texts = [None if rnd.random() < 0.1 else "\n".join(rnd.choice(["", "A", "é  b", "--", "cc, d!"]) for _ in range(rnd.randint(0, 6)))
                 for _ in range(rnd.randint(0, 5))]
        gone, want, removed = [], [], []
        for text in texts:
            sig = signatures(text)
            drop = {k for k in sig if rnd.random() < 0.4}
            marks = [{"line": k, "sig": sig[k]} for k in drop]
            # lines that another row of the id has: they stay here
            marks += [{"line": rnd.randint(0, 9), "sig": b"x" * 16} for _ in range(rnd.randint(0, 2))]
            gone.append(marks or None)
            removed.append(len(drop))
            want.append(None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop))
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string()), pa.array(gone, gone_type)],
                                           names=["doc_id", "text", "gone"])
        total, cut_lines, left = cut(batch)
        assert left.to_pylist() == want and list(cut_lines) == removed and list(total) == [len(signatures(t)) for t in texts]
        asked = [sorted(rnd.sample(range(8), rnd.randint(0, 4))) for _ in texts]
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(asked, pa.list_(pa.int32()))], names=["text", "asked"])
        got = [(bytes(s), t) for out in lines._wanted_lines([batch]) for s, t in zip(out.column(0).to_pylist(), out.column(1).to_pylist())]
        parts = [(t or "").split("\n") for t in texts]
        lines_ = [p[k] for p, numbers in zip(parts, asked) for k in numbers if k < len(p) and plain(p[k])]
        assert got == [(signatures(x)[0], plain(x)) for x in lines_]


def test_line_dedup_against_brute_force(spark):
    rnd = random.Random(5)
    base = [f"word{i}" for i in range(80)]
    near = near_copies(rnd, 12, base, 1)  # one word in 80: always within 20 % edits
    rows = [(0, None), (1, ""), (2, "\n \n###"), (3, "Same line here.\nsame LINE here!\n\nother"), (4, "same line here\nown line four"),
            (None, "same line here"), (5, "other\nother"), (5, "other\nother"), (6, "x " * 50_000)]
    rows += [(10 + i, f"first of {i} zz{i * 7919}\n{t}\nlast") for i, t in enumerate(near)]
    docs = table(spark, rows)
    report = lines.line_report(docs).collect()
    assert len(report) == len(rows)
    # every pair of candidates that the SimHash blocks give
    distinct = sorted({plain(x) for i, t in rows if i is not None and t for x in t.split("\n")} - {""})
    reader = lines.LineReader()
    import pyarrow as pa

    from ratesmith.llm import kernels as K
    _, _, _, word, _, _, first, size, _ = reader.read(*K.text_buffer(pa.array(distinct)))
    blocks = lines.simhash_blocks(word, first, size)
    u = Union(range(len(distinct)))
    for i in range(len(distinct)):
        for j in range(i):
            same = np.flatnonzero(blocks[i] == blocks[j])
            beside = [sum(int(blocks[i][(k + s) % 8] ^ blocks[j][(k + s) % 8]).bit_count() for s in (1, 3)) for k in same]
            if any(b <= lines.OTHER_BITS for b in beside) and lines.similar(distinct[i], distinct[j]):
                u.join(i, j)
    group = {t: u.find(i) for i, t in enumerate(distinct)}
    seen = sorted((i, k, group[plain(x)]) for i, t in rows if i is not None and t for k, x in enumerate(t.split("\n")) if plain(x))
    keep = {}
    for i, k, g in seen:
        keep.setdefault(g, (i, k))
    want = collections.Counter()
    for i, t in rows:
        parts = (t or "").split("\n")
        drop = [k for k, x in enumerate(parts) if i is not None and plain(x) and keep[group[plain(x)]] != (i, k)]
        left = "\n".join(x for k, x in enumerate(parts) if k not in drop)
        want[(i, sum(bool(plain(x)) for x in parts), len(drop), hashlib.sha256(left.encode()).hexdigest())] += 1
    assert collections.Counter(tuple(r) for r in report) == want
    assert len({group[plain(t)] for t in near}) < len({plain(t) for t in near})
    kept = lines.dedup_lines(docs)
    emptied = sum(n for (_, lines_, gone, _), n in want.items() if lines_ and lines_ == gone)  # both rows 5 among them
    assert emptied >= 2 and kept.columns == docs.columns and kept.count() == len(rows) - emptied
    assert lines.line_report(docs.where("false")).count() == 0


def removed_lines(spark, texts):
    """The numbers of the lines removed, one document a line."""
    return {r.doc_id for r in lines.line_report(table(spark, list(enumerate(texts)))).collect() if r.n_removed}


def test_short_lines_with_one_changed_word_against_all_pairs(spark):
    rnd = random.Random(7)
    fresh = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(4, 8)))
    texts = []
    for size in (2, 3, 4, 5, 8, 12, 13, 20, 50):
        base = [fresh() for _ in range(size)]
        texts.append(" ".join(base))
        for at in {0, size // 2, (size - 1) // 2, size - 1}:
            texts.append(" ".join(base[:at] + [base[at][:-1] + "0"] + base[at + 1:]))  # a typo
            texts.append(" ".join(base[:at] + ["0" * len(base[at])] + base[at + 1:]))
            texts.append(" ".join(base[:at] + ["a"] + base[at:]))
            texts.append(" ".join(base[:at] + base[at + 1:]))
        three = list(base) if size >= 4 else []
        for at in rnd.sample(range(size), 3 if three else 0):
            three[at] = three[at][:-1] + "1"
        texts += [" ".join(three)] if three else []
    texts = list(dict.fromkeys(texts))
    u = Union(range(len(texts)))
    for i, a in enumerate(texts):
        for j in range(i):
            if 5 * levenshtein(a, texts[j]) <= max(len(a), len(texts[j])):
                u.join(i, j)
    want = {i for i in range(len(texts)) if u.find(i) != i}
    assert len(want) > 100 and removed_lines(spark, texts) == want


def test_line_links_do_not_depend_on_the_length_of_a_list(spark):
    rnd = random.Random(8)
    fresh = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    start = [fresh() for _ in range(10)]  # all lines share their first half, so one list has them all
    pair = [" ".join(start + [fresh() for _ in range(10)])]
    pair.append(" ".join(w[:-1] + "0" if k in (11, 14, 17, 19) else w for k, w in enumerate(pair[0].split())))
    other = [" ".join(start + [fresh() for _ in range(10)]) for _ in range(300)]
    assert lines.similar(*pair) and not any(lines.similar(p, o) for p in pair for o in other)
    for pad in (0, 254, 255, 300):
        assert 1 in removed_lines(spark, pair + other[:pad])


def test_a_list_keeps_similar_lines_at_any_size():
    import pyarrow as pa

    def kept(length):  # lines that share every key, of these lengths
        n = len(length)
        keys = np.column_stack([np.ones((n, lines.KEYS), np.uint32), np.array(length, np.uint32)])
        sig = np.column_stack([np.arange(n, dtype=np.uint64), np.zeros(n, np.uint64)])
        batch = pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x]) for x in (sig, keys)], names=["sig", "simhash"])
        out = lines._shared_blocks(pa.Table.from_batches(lines._block_entries(1)([batch])))
        return {int.from_bytes(h, "little") for h in out.column("half").to_pylist()}

    for more in (0, 1, 254, 255, 256, 400):
        assert kept([80, 100] + [1000] * more) == {0, 1} | (set(range(2, more + 2)) if more > 1 else set())
        assert kept([79, 100] + [1000] * more) == (set(range(2, more + 2)) if more > 1 else set())
    assert kept([70_000, 60_000, 20]) == {0, 1}


def test_majority_blocks_count_every_bit_of_short_and_long_lines():
    r = np.random.default_rng(3)
    size = np.array([1, 2, 3, 4, 7, 8, 126, 127, 128, 129, 254, 255, 256, 700] + list(r.integers(1, 40, 60)))
    r.shuffle(size)
    first = np.cumsum(size) - size
    word = r.integers(0, 1 << 40, size.sum()).astype(np.uint64)
    word[5:9] = word[5]  # a word counts once per line
    got = lines._majority_blocks(word, first, size)
    for k in range(len(size)):
        distinct = np.unique(word[first[k]: first[k] + size[k]])
        raw = np.stack([K.mix(distinct + np.uint64(s)) for s in lines._SALTS], axis=1).view(np.uint8)
        ones = np.unpackbits(raw, axis=1).sum(axis=0)
        assert (got[k] == np.packbits(2 * ones > len(distinct)).view(np.uint32)).all()


def test_distinct_lines_keep_the_first_place_and_the_number():
    rows = [(7, "Same line\nother"), (3, "x\nsame  LINE"), (3, "x\ny\nsame line"), (9, ""), (5, "same line"), (None, None)]
    rows = [r for r in rows if r[0] is not None]
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array([i for i, _ in part], pa.int64()), pa.array([t for _, t in part], pa.string())],
                                                    names=["doc_id", "text"])
    for buckets in (1, 4):
        out = [pa.Table.from_batches(list(lines._occurrences(buckets)(iter([batch(part)])))) for part in (rows[:2], rows[2:])]
        sent = pa.concat_tables([t.filter(t.column("payload").is_valid()) for t in out])
        seen = pa.concat_tables([t.filter(t.column("sig").is_valid()) for t in out])
        assert seen.num_rows == 8
        told = [lines._distinct_lines(sent.filter(pc.equal(sent.column("bucket"), b))) for b in sorted(set(sent.column("bucket").to_pylist()))]
        told = pa.concat_tables(told)
        one = told.filter(told.column("sig").is_valid()).select(["doc_id", "line", "times"]).to_pylist()
        assert sorted((r["doc_id"], r["line"], r["times"]) for r in one) == [(3, 0, 2), (3, 1, 1), (3, 1, 4), (7, 1, 1)]
        # the keys travel packed, many lines to a row
        packed = told.filter(told.column("keys").is_valid())
        assert sum(len(x) for x in packed.column("keys").to_pylist()) == 4 * 4 * (lines.KEYS + 1) and packed.num_rows < 4 + buckets


# ---- 10: suffix repeats --------------------------------------------------------------------

def repeats(rows, length):
    where = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        where.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = collections.Counter()
    for doc, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if where[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[(doc, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("length, digits", [(40, 15), (400, 15), (40, 1)])  # one digit: most texts share their key
def test_repeats_against_brute_force(spark, monkeypatch, length, digits):
    monkeypatch.setattr(suffixes, "KEY_DIGITS", digits)
    rnd = random.Random(length)
    letters = "abcdefghé "
    fresh = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    passages = [fresh(length + d) for d in (-1, 0, 1, 7, length)]
    rows = [(0, None), (1, ""), (2, "short"), (2, "short"), (None, fresh(2 * length)), (3, "z" * (3 * length)), (4, "ab" * length)]
    for i in range(60):
        parts = [fresh(rnd.randint(0, length)) for _ in range(3)] + rnd.sample(passages, rnd.randint(0, 2))
        rnd.shuffle(parts)
        rows.append((10 + i, "".join(parts)))
    rows += [(200, rows[20][1]), (201, rows[20][1]), (201, rows[20][1]), (None, rows[30][1])]
    docs = table(spark, rows)
    got = collections.Counter(tuple(r) for r in suffixes.repeat_digests(docs, length).collect())
    assert got == repeats(rows, length)


def test_repeats_of_nothing(spark):
    docs = table(spark, [(1, "abc"), (2, None)])
    assert sorted(r.n_removed for r in suffixes.repeat_digests(docs).collect()) == [0, 0]
    assert suffixes.repeat_digests(docs.where("false")).count() == 0


def test_every_listed_cover_is_a_difference_cover():
    for v, cover in suffixes.PERFECT_COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert suffixes.difference_cover(400)[0] == 133


def test_packed_samples_come_back():
    key = np.array([5, 5, 5, -9, 7, 7])
    pos = np.array([0, 3, 400_000, 12, 1, 2])
    h = np.array([1, 2, 3, 2**40 - 1, 5, 6], dtype=np.uint64)
    got = suffixes.unpack_sample(suffixes.pack_sample(key, pos, h))
    assert [list(x) for x in got] == [list(key), list(pos), list(h)]
