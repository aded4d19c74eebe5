"""Secret scans: keyed, access-key and hex patterns plus sliding-window entropy (operator 9).

DataFrame functions only.  Base spans are the leftmost, non-overlapping matches of three
patterns (assign, access, hex).  The method adds spans of kind ``entropy``: in every run of
a character class (hex digits; base-64 characters) of at least ``WINDOW`` characters, a
window slides over the run and its Shannon entropy is kept up to date from the counts of the
entering and the leaving character.  Overlapping windows at or above the class's threshold
are united to a span.  Runs that an allow-list explains (only letters, only digits, UUIDs,
names joined by signs) are suppressed, and so are spans that hold an example key or an alphabet
and spans inside a base span.

The entropy is exact integer arithmetic (millionths of a bit), so results do not depend on
the order of additions.  Positions are code points, ends are exclusive.

Defined cases: a null or empty text has no spans; rows are judged one by one, so repeated
rows, null ids and other columns do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 20
#: Character classes: name, run of the class, least entropy of a window in bits.
CLASSES = (
    ("hex", r"[0-9A-Fa-f]{20,}", 3.0),
    ("base64", r"[A-Za-z0-9+/_=-]{20,}", 3.9),
)
#: Runs that are no secrets, matched against the whole run.  A group that repeats without bound is possessive:
#: Java's matcher would otherwise recurse once per repetition.  No match is lost, as its parts are told apart by their signs.
ALLOWED = (
    r"[A-Za-z+/_=-]+",  # letters only: words, also joined ones
    r"[0-9+/_=-]+",  # numbers, dates, telephone numbers
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUID
    r"(?:[A-Za-z]+[0-9]{0,4}[/_=+-])++[A-Za-z]*[0-9]{0,4}",  # paths, slugs and version names
)
#: Spans that are no secrets when they hold one of these: documentation, alphabets.
ALLOWED_WITHIN = r"EXAMPLE|example|XXXX|xxxx|0123456789|abcdefghij|ABCDEFGHIJ"
# The patterns of the base kinds, in their order; the last number is the least length of the group.
BASE = (
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    ("access", r"(AKIA[A-Z0-9]{14,})", 0),  # 18 or more characters in all
    ("hex", r"([0-9a-f]{16,})", 0),
)
KIND_ORDER = ("assign", "access", "hex", "entropy")

_SPAN = "array<struct<start:int,kind:int,end:int>>"
_RUNS = "array<struct<start:int,text:string>>"


def _matches(text: Column, pattern: str, group: int) -> Column:
    """array<struct<start, whole, group>> of the matches; the gaps between them give the positions."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
    kind = "array<struct<start:int,whole:string,part:string>>"
    none = F.array().cast(kind)
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(state, z):
        gap, whole, part = z["gap"], z["whole"], z["part"]
        at = state["at"] + F.length(gap)
        return F.when(whole.isNull(), state).otherwise(F.struct(
            (at + F.length(whole)).alias("at"),
            F.concat(state["out"], F.array(F.struct(at.alias("start"), whole.alias("whole"), part.alias("part"))).cast(kind)).alias("out")))

    return F.when(text.rlike(pattern), F.aggregate(zipped, start, step, lambda s: s["out"])).otherwise(none)


def _base_spans(text: Column, kind: str) -> Column:
    name, pattern, least = next(b for b in BASE if b[0] == kind)
    found = _matches(text, pattern, 1)
    if least:
        found = F.filter(found, lambda m: F.length(m["part"]) >= least)
    order = KIND_ORDER.index(name)
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("kind"),
                                                 (m["start"] + F.length(m["whole"])).alias("end"))).cast(_SPAN)


def weight(count: int) -> int:
    """count * log2(count) in millionths of a bit."""
    return round(count * math.log2(count) * 1_000_000) if count else 0


def highest_sum(bits: float) -> int:
    """A window has at least ``bits`` of entropy when its counts' weights sum to at most this."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * 1_000_000)


def window_spans(run: Column, bits: float) -> Column:
    """array<struct<start, end>> of the united windows of an ASCII string with enough entropy."""
    spans = "array<struct<start:int,end:int>>"
    f = F.array(*[F.lit(weight(c)).cast("long") for c in range(WINDOW + 1)])
    codes = F.transform(F.split(run, "(?<=.)", -1), F.ascii)  # one pass; the piece after the last character is empty
    codes = F.slice(codes, F.lit(1), F.length(run))
    # each step sees the entering code and the one WINDOW places before it (-1 at first)
    leaving = F.concat(F.array_repeat(F.lit(-1), WINDOW), codes)
    steps = F.filter(F.arrays_zip(codes.alias("enter"), leaving.alias("leave")), lambda z: z["enter"].isNotNull())
    start = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("i"),
                     F.lit(-1).alias("from"), F.lit(-1).alias("to"), F.array().cast(spans).alias("out"))

    def step(s, z):
        enter, leave = z["enter"], z["leave"]
        old = F.when(leave >= 0, F.get(s["counts"], leave)).otherwise(0)
        less = F.when(leave >= 0, F.get(f, old - 1) - F.get(f, old)).otherwise(F.lit(0).cast("long"))
        new = F.get(s["counts"], enter) - F.when(leave == enter, 1).otherwise(0)
        total = s["sum"] + less + F.get(f, new + 1) - F.get(f, new)
        counts = F.transform(s["counts"], lambda c, k: c + F.when(k == enter, 1).otherwise(0) - F.when(k == leave, 1).otherwise(0))
        hit = (s["i"] >= WINDOW - 1) & (total <= highest_sum(bits))
        begin = s["i"] - (WINDOW - 1)
        joins = hit & (s["to"] >= begin)
        closed = hit & (s["to"] < begin) & (s["to"] >= 0)
        out = F.when(closed, F.concat(s["out"], F.array(F.struct(s["from"].alias("start"), s["to"].alias("end"))).cast(spans))).otherwise(s["out"])
        return F.struct(counts.alias("counts"), total.alias("sum"), (s["i"] + 1).alias("i"),
                        F.when(hit & ~joins, begin).otherwise(s["from"]).alias("from"),
                        F.when(hit, s["i"] + 1).otherwise(s["to"]).alias("to"), out.alias("out"))

    def finish(s):
        last = F.array(F.struct(s["from"].alias("start"), s["to"].alias("end"))).cast(spans)
        return F.when(s["to"] >= 0, F.concat(s["out"], last)).otherwise(s["out"])

    return F.aggregate(steps, start, step, finish)


def _entropy_spans(text: Column, pattern: str, bits: float) -> Column:
    runs = F.transform(_matches(text, pattern, 0), lambda m: F.struct(m["start"].alias("start"), m["whole"].alias("text"))).cast(_RUNS)
    allowed = r"^(?:" + "|".join(ALLOWED) + r")$"
    runs = F.filter(runs, lambda r: ~r["text"].rlike(allowed))
    kind = KIND_ORDER.index("entropy")
    return F.flatten(F.transform(runs, lambda r: F.transform(
        F.filter(window_spans(r["text"], bits),
                 lambda w: ~F.substring(r["text"], w["start"] + 1, w["end"] - w["start"]).rlike(ALLOWED_WITHIN)),
        lambda w: F.struct((r["start"] + w["start"]).alias("start"), F.lit(kind).alias("kind"), (r["start"] + w["end"]).alias("end"))))).cast(_SPAN)


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KIND_ORDER])
    one = F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def find_secrets(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, text, and the arrays ``assign``, ``access``, ``hex`` and ``entropy`` of (start, kind, end)."""
    text = F.col("text")
    out = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = out.withColumns({k: _base_spans(text, k) for k, _, _ in BASE})
    out = out.withColumns({f"runs_{name}": _entropy_spans(text, pattern, bits) for name, pattern, bits in CLASSES})
    base = F.concat(*[F.col(k) for k, _, _ in BASE])
    extra = F.array_distinct(F.concat(*[F.col(f"runs_{name}") for name, _, _ in CLASSES]))
    inside = lambda s: F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))
    return out.withColumn("entropy", F.filter(extra, lambda s: ~inside(s))).drop(*[f"runs_{c[0]}" for c in CLASSES])


def secret_report(documents: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    base = F.concat(*[F.col(k) for k, _, _ in BASE])
    return find_secrets(documents).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k, _, _ in BASE],
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.concat(base, F.col("entropy"))).alias("spans"))


def mask_secrets(documents: DataFrame, mask: str = "[secret]") -> DataFrame:
    """(doc_id, text) with every span, united where they overlap, replaced by ``mask``."""
    found = find_secrets(documents)
    spans = F.array_sort(F.concat(*[F.col(k) for k in KIND_ORDER]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s, x):
        begins = x["start"] >= s["at"]
        piece = F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, x["start"] - s["at"]), F.lit(mask))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(begins, piece).otherwise(s["out"]).alias("out"))

    masked = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    return found.select("doc_id", masked.alias("text"))
