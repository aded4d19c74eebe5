"""Models' verdicts restated in plain Python, forms of licence texts, shared windows, and the pipeline as a chain."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from ratesmith.llm import decontaminate, lines, quality, toxicity, licences
from test_corpus_operators import Union, linked_groups, near_copies, plain
from test_text_operators import SPACED, base_rules, contaminated

MASK, BASE = (1 << 64) - 1, 0x9E3779B97F4A7C15


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "b", 1) for i, t in rows], "doc_id long, text string, bucket string, n int").repartition(3)


def mixed(x):
    """The 64-bit finaliser, on one number."""
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


BYTES = [mixed(i * BASE & MASK) for i in range(1, 257)]


def spelled(raw):
    return sum(BYTES[c] * pow(BASE, j, 1 << 64) for j, c in enumerate(raw)) & MASK


def hash_fold(spark, ids, bits):
    rows = spark.createDataFrame([(i,) for i in ids], "i long").select("i", F.xxhash64("i").alias("h")).collect()
    return {r.i: r.h & bits for r in rows}


# ---- 3: the likelihood ratio ---------------------------------------------------------------

def buckets(text):
    words = [mixed(spelled(w.encode()) ^ len(w.encode())) for w in re.findall(SPACED, text or "")]
    pairs = [mixed((a * 3 + b) & MASK) for a, b in zip(words, words[1:])]
    return [x % quality.BUCKETS for x in words + pairs]


def test_quality_verdicts_against_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 64)  # small, so that add-one counts do not drown the target
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(30)] + ["ünï", "日本"]
    text = lambda weights: " ".join(rnd.choices(words, weights, k=rnd.randint(52, 90)))
    up, down = [1 + k for k in range(32)], [33 - k for k in range(32)]
    rows = [(0, None), (1, ""), (2, "short text")] + [(10 + i, text(up if i % 2 else down)) for i in range(80)] + [(500, "w1 " * 80), (501, "w1 " * 80)]
    marked = {10 + i: int(i % 2) for i in range(60)}
    labels = spark.createDataFrame([(i, q, 0) for i, q in marked.items()], "doc_id long, quality int, toxic int")
    odd = hash_fold(spark, marked, 1)
    raw, target = [1] * 64, [1] * 64
    for i, t in rows:
        for x in buckets(t):
            raw[x] += 1
            target[x] += marked.get(i) == 1 and odd[i] == 0
    ratio = [math.log(a / sum(target)) - math.log(b / sum(raw)) for a, b in zip(target, raw)]
    score = lambda t: sum(ratio[x] for x in buckets(t)) / max(1, len(buckets(t)))
    held = [(marked[i] == 1, math.floor(score(t) * 1000)) for i, t in rows if i in marked and not base_rules(t)[-1] and (marked[i] == 0 or odd[i] == 1)]
    good, bad = ([c for g, c in held if g == side] for side in (True, False))
    loss = {c: quality.LOSS_OF_GOOD * sum(x < c for x in good) / len(good) + sum(x >= c for x in bad) / len(bad)
            for c in range(min(good + bad), max(good + bad) + 2)}
    best = [c for c in loss if loss[c] <= min(loss.values()) + 1e-12]
    run = [c for k, c in enumerate(best) if c == best[0] + k]
    threshold = run[len(run) // 2] / 1000
    got = {r.doc_id: r for r in quality.quality_scores(docs_of(spark, rows), labels).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert abs(got[i].llr - score(t)) < 1e-9
        assert got[i].kept == (not base_rules(t)[-1] and score(t) >= threshold) or abs(score(t) - threshold) < 1e-9
    judged = [got[i].kept for i, t in rows if not base_rules(t)[-1]]
    assert 10 < sum(judged) < len(judged) - 10


def test_quality_counts_every_labelled_document(spark, monkeypatch):
    """Far over 20,000 documents of each part; the plain counts come from one aggregation."""
    kind = F.col("doc_id") % 3
    docs = spark.range(0, 120_000, 1, 4).withColumnRenamed("id", "doc_id").withColumn(
        "text", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(49)), lambda k: F.concat(F.lit("k"), kind.cast("string"), F.lit("w"), k.cast("string"))), " "))
    # of the third kind only ids over 60,000 are good, all others are bad
    good = (kind < 2) | (F.col("doc_id") >= 60_000)
    labels = docs.select("doc_id", good.cast("int").alias("quality"), F.lit(0).alias("toxic"))
    trusted = {r.kind: r.n for r in docs.where(good & (F.xxhash64("doc_id").bitwiseAND(F.lit(1)) == 0))
               .groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).collect()}
    assert sum(trusted.values()) > 45_000
    texts = {k: " ".join(f"k{k}w{i}" for i in range(50)) for k in range(3)}
    raw, target = collections.Counter(), collections.Counter()
    for k, t in texts.items():
        for x in buckets(t):
            raw[x] += 40_000
            target[x] += trusted[k]
    all_raw, all_target = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    ratio = {x: math.log((1 + target[x]) / all_target) - math.log((1 + raw[x]) / all_raw) for x in raw}
    want = {k: sum(ratio[x] for x in buckets(t)) / len(buckets(t)) for k, t in texts.items()}
    for bound in (quality.BROADCAST_IDS, 10):  # picked out by a broadcast list, and by a shuffle
        monkeypatch.setattr(quality, "BROADCAST_IDS", bound)
        got = quality.quality_scores(docs, labels).groupBy((F.col("doc_id") % 3).alias("kind")).agg(
            F.min("llr").alias("lo"), F.max("llr").alias("hi"), F.min("kept").alias("all"), F.max("kept").alias("any")).collect()
        assert len(got) == 3
        for r in got:
            assert abs(r.lo - want[r.kind]) < 1e-9 and abs(r.hi - want[r.kind]) < 1e-9 and r.all == r.any


def test_quality_repeated_and_null_ids_count_by_row(spark, monkeypatch):
    word = lambda k: " ".join(f"k{k}w{i}" for i in range(60))
    ids = list(range(40))
    odd = hash_fold(spark, ids, 1)
    marked = {i: int(i >= 10) for i in ids}
    rows = [(i, word(marked[i])) for i in ids] * 2 + [(None, word(0)), (None, word(1)), (99, word(1))]
    marks = [(i, q, 0) for i, q in marked.items()] * 2 + [(None, 1, 0), (None, 0, 0), (99, 1, 0), (99, 0, 0), (7, None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    raw, target = collections.Counter(), collections.Counter()
    for i, t in rows:
        for x in buckets(t):
            raw[x] += 1
            target[x] += marked.get(i) == 1 and odd[i] == 0
    all_raw, all_target = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    ratio = {x: math.log((1 + target[x]) / all_target) - math.log((1 + raw[x]) / all_raw) for x in raw}
    for bound in (quality.BROADCAST_IDS, 10):
        monkeypatch.setattr(quality, "BROADCAST_IDS", bound)
        got = quality.quality_scores(docs_of(spark, rows), labels).collect()
        assert len(got) == len(rows)
        for r in got:
            t = word(marked.get(r.doc_id, 1))
            if r.doc_id is not None:
                assert abs(r.llr - sum(ratio[x] for x in buckets(t)) / len(buckets(t))) < 1e-9 and r.kept == (marked.get(r.doc_id, 1) == 1)
        assert [r.kept for r in got if r.doc_id is None].count(True) == 1



# ---- 2: the chain --------------------------------------------------------------------------

def features(text):
    """{feature: value} of a text, as the module's docstrings define them."""
    found = re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    count = collections.Counter()
    for w in found:
        raw = w.encode()
        count[mixed(spelled(raw)) % toxicity.FEATURES] += 1
        for k in toxicity.BEGINNINGS:
            if len(raw) > k:
                count[mixed(spelled(raw[:k]) ^ k) % toxicity.FEATURES] += 1
    return {f: math.log1p(n) * math.log1p(200 * n / len(found)) for f, n in count.items()}


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def labelled(spark, n=90):
    rnd = random.Random(12)
    calm, rude = [f"calm{i}" for i in range(40)], [f"rudeword{i}" for i in range(8)]
    rows, marks = [], []
    for i in range(n):
        toxic, low = int(i % 3 == 0), int(i % 2 == 0)
        words = rnd.choices(calm, k=40) + (rnd.choices(rude, k=6) if toxic else []) + (["spam"] * 4 if low else [])
        rnd.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, 1 - low, toxic))
    return rows, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_chain_scores_against_their_formula(spark):
    rows, marks = labelled(spark)
    chain = toxicity.fit(docs_of(spark, rows), marks)
    extra = [(1000, None), (1001, ""), (1002, "Rudeword1 RUDEWORD2 calm3 ünï"), (1003, "rudeword1 " * 3000), (None, "calm1 calm2"), (5, rows[5][1])]
    got = collections.defaultdict(list)
    for r in toxicity.toxicity_scores(docs_of(spark, rows + extra), marks, chain).collect():
        got[r.doc_id].append(r)
    for i, text in rows + extra:
        earlier = []
        for name in toxicity.CATEGORIES:
            model, own = chain.models[name], features(text)
            weight = dict(zip(model.features.tolist(), model.weights.tolist()))
            z = sum(weight.get(f, 0.0) * v for f, v in own.items()) + model.constant
            earlier.append(sigmoid(z + sum(p * w for p, w in zip(earlier, model.earlier))))
        for r in got[i]:
            assert np.allclose([r.p_low_quality, r.p_toxic, r.p_toxic_low], earlier, atol=2e-5)
            assert r.toxic == (bool(text) and earlier[1] >= chain.threshold) or abs(earlier[1] - chain.threshold) < 1e-4
    assert sum(got[i][0].toxic == (i % 3 == 0) for i, _ in rows) >= 85 and len(got[5]) == 2


def test_later_models_train_on_out_of_fold_probabilities(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    n = 60
    label = {"first": rnd.random(n) < 0.4, "toxic": rnd.random(n) < 0.4}
    rows = toxicity.Rows([np.sort(rnd.choice(50, 8, replace=False)) for _ in range(n)], [rnd.random(8) for _ in range(n)])
    fold = np.arange(n) % toxicity.FOLDS
    calls, train = [], toxicity._train
    monkeypatch.setattr(toxicity, "_train", lambda r, y, earlier, among, **k: calls.append((y, earlier, among)) or train(r, y, earlier, among, **k))
    toxicity.train_chain(rows, label, fold)
    outside = np.zeros(n)
    for k in range(toxicity.FOLDS):
        alone = train(rows, label["first"], np.zeros((n, 0)), fold != k)
        outside[fold == k] = toxicity._apply(alone, rows, np.zeros((n, 0)))[fold == k]
    later = [c for c in calls if c[0] is label["toxic"]]
    assert len(later) == toxicity.FOLDS + 1
    for _, earlier, among in later:
        assert earlier.shape == (n, 1) and np.allclose(earlier[:, 0], outside)
    assert [int(among.sum()) for _, _, among in later] == [40, 40, 40, 60]


def test_repeated_ids_reach_the_driver_once(spark):
    rows, marks = labelled(spark, 30)
    many = rows + [rows[0]] * 500 + [(1, "another text of the same id")]
    once = toxicity.fit(docs_of(spark, rows), marks)
    again = toxicity.fit(docs_of(spark, many), marks)
    assert set(once.models) == set(again.models)
    least = toxicity.fit(docs_of(spark, rows + [rows[0]] * 500), marks)
    assert all(np.allclose(once.models[c].weights, least.models[c].weights) for c in once.models)


# ---- 1: forms of licence texts -------------------------------------------------------------

def licence_forms():
    """(text, licence): every rule's sentences on one line, hard-wrapped, as a comment, and numbered."""
    text = dict(licences.SENTENCES)
    for licence, sequence in licences.RULES:
        sentences = [text[s][0].upper() + text[s][1:] + "." for s in sequence]
        whole = " ".join(sentences)
        wrapped, line = [], ""
        for word in whole.split(" "):
            if len(line) + len(word) > 60 and not any(word.startswith(o) for o in licences.OPENINGS):
                wrapped, line = wrapped + [line], ""
            line = f"{line} {word}".strip()
        wrapped.append(line)
        yield whole, licence
        yield "\n".join(wrapped), licence
        yield "\n".join("# " + x for x in wrapped), licence
        yield "\n".join(" * " + x for x in wrapped), licence
        yield "\n\n".join(f"{k}. {s}" for k, s in enumerate(sentences, 1)), licence


def test_every_rule_in_every_form(spark):
    forms = list(licence_forms())
    got = {r.doc_id: r for r in licences.scan_licences(docs_of(spark, [(i, t) for i, (t, _) in enumerate(forms)])).collect()}
    wrong = [(forms[i], got[i].licences, got[i].left_over) for i in got if got[i].licences != forms[i][1] or got[i].left_over]
    assert not wrong, wrong[:3]


def test_a_cue_across_a_comment_line(spark):
    rows = [(1, "# This is free and unencumbered software released into the public\n# domain."), (2, "// All rights\n// reserved."),
            (3, "free\n-- software"), (4, "x" * 1_000_000), (5, "a1/" * 300_000), (6, "1. " * 200_000)]
    got = {r.doc_id: r.licences for r in licences.scan_licences(docs_of(spark, rows)).collect()}
    assert got == {1: "Unlicense", 2: "All-rights-reserved", 3: "", 4: "", 5: "", 6: ""}


# ---- 8: windows that many items share ------------------------------------------------------

def test_items_that_all_share_a_window(spark, monkeypatch):
    shared = " ".join(f"s{k}" for k in range(13))
    items = [(i, f"{shared} own{i} a{i} b{i}") for i in range(60)] + [(i + 100, f"short{i} item") for i in range(5)]
    rows = [(0, None), (1, ""), (2, shared), (2, shared), (None, f"x {shared} own7 a7 b7"), (3, "nothing at all " * 30), (4, "Short3, ITEM " * 200)]
    rows += [(10 + i, f"{'w ' * i}{shared} own{i} z {shared}") for i in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    docs = docs_of(spark, rows)
    seen = []
    block = decontaminate._block
    monkeypatch.setattr(decontaminate, "_block", lambda spark, windows: seen.append(len(windows)) or block(spark, windows))
    for size in (10_000, 40):
        monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", size)
        marked = decontaminate.mark_hits(docs, bench, block_windows=size)
        assert marked.columns[:4] == docs.columns
        got = marked.select("doc_id", decontaminate.WORDS, decontaminate._n_hit(), F.size(decontaminate.ITEMS),
                            F.sha2(F.array_join(F.array_sort(decontaminate.ITEMS), ",").cast("binary"), 256), decontaminate._contaminated()).collect()
        assert sorted(map(tuple, got), key=str) == contaminated(rows, items)
    assert seen[0] == sum(seen[1:]) and len(seen) > 5 and max(seen[1:]) < 90  # the shared window is in every block, not in one


# ---- the pipeline --------------------------------------------------------------------------

def test_pipeline_against_its_stages_restated(spark, scratch):
    rnd = random.Random(13)
    vocabulary = [f"{a}{b}" for a, b in itertools.product("alpha beta gamma delta kappa sigma omega theta".split(), "red blue green one two three".split())]
    prose = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    bench = [(1, prose(30)), (2, prose(20)), (3, None)]
    boiler = prose(14)
    base = [rnd.choice(vocabulary) + str(k) for k in range(120)]
    texts = [None, "", "too short", "again and again " * 40]
    texts += [f"{prose(40)}\n{boiler}\n{prose(30)}\n{prose(20)}" for _ in range(25)]
    texts += [texts[6], texts[7] + "\n" + prose(12)]  # an exact copy, and one with a line more
    texts += [f"{prose(60)} {bench[0][1]}", f"{prose(3)} {bench[1][1]} {prose(40)}"]
    texts += near_copies(rnd, 6, base, 1)
    rows = list(enumerate(texts))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).repartition(2).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")

    kept = [(i, t) for i, t in rows if not base_rules(t)[-1]]  # without labels the base rules decide
    seen = sorted({plain(x) for _, t in kept for x in t.split("\n")} - {""})
    u = Union(range(len(seen)))
    for a, b in itertools.combinations(range(len(seen)), 2):
        if lines.similar(seen[a], seen[b]):
            u.join(a, b)
    group, first, thinned = {t: u.find(k) for k, t in enumerate(seen)}, {}, []
    for i, t in kept:
        left = [x for k, x in enumerate(t.split("\n")) if not plain(x) or first.setdefault(group[plain(x)], (i, k)) == (i, k)]
        if any(map(plain, left)):
            thinned.append((i, "\n".join(left)))
    component = {doc: c for doc, _, c in linked_groups(thinned)}
    single = [(i, t) for i, t in thinned if component[i] == i]
    dirty = {d for d, *_, bad in contaminated(single, bench) if bad}
    clean = [(i, t) for i, t in single if i not in dirty]
    tool = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    tool.no_truncation()
    tool.no_padding()
    want = set()
    for i, t in clean:
        ids = tool.encode(t, add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                  hashlib.sha256(tool.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert len(rows) > len(kept) > len(thinned) and dirty and len(clean) > 20
    got = corpus_pipeline.run(spark, scratch).collect()
    assert {tuple(r)[:4] for r in got} == want and len(got) == len(want)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, scratch).columns == docs.columns, name
        assert stage(spark, docs.where("false"), scratch).count() == 0, name
