"""Fuzzy line dedup (operator 7).

Lines are the ``\\n``-split parts of a text.  A line is normalised to its lower-case (A-Z)
words of digits, ASCII letters and non-ASCII characters, joined by single spaces; lines
without such a word are never touched.  Equal normalised lines are one line.  Every
distinct line gets 16 keys of 32 bits; lines that agree in a key are candidates, however many
lines share it, and linked when the edit similarity of the normalised lines, 1 - distance /
longer length, is at least ``SIMILARITY_PERCENT``.  Of each connected group of lines one occurrence
is kept, the first by (doc_id, line number); all others are removed with their line break.

The keys, and the pairs that by the pigeonhole principle have one in common:

- 8 blocks of a 256-bit SimHash of the distinct words: pairs within 7 differing bits;
- the words of the first and of the last half, each in an even and an odd number: pairs that
  one word replaced, added or removed turns into each other (lines of two words or more);
- the four quarters of the words, with their number: pairs of lines of as many words, at least
  four, with up to three words replaced.

Other similar pairs are found only by a chance equal key (measured recall in the README).

Defined cases: a null or empty text has no lines with words; rows without a doc_id lose
nothing and take part in nothing; rows of one id and equal lines keep the same lines; an
empty table gives an empty result; other columns are carried unchanged, but ``n_chars``, where
present as a number, follows the new text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded
from ratesmith.llm.edits import Strings, edit_distance
from ratesmith.llm.jaccard import _fixed_binary
from ratesmith.llm.links import linked_components
from ratesmith.session import cut_lineage

SIMILARITY_PERCENT = 80
BLOCKS = 8
#: Of a block's 64 neighbouring bits all may differ: an equal key alone makes a candidate.
OTHER_BITS = 64
#: Keys of a line: SimHash blocks, halves (two lengths at either end), quarters.
KEYS = BLOCKS + 4 + 4
#: Greater lengths count as this one, which only keeps more candidates.
LONGEST = 65_535
_SALTS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]


#: For each byte, its eight bits (highest first) as eight one-byte counters of a 64-bit number.
_COUNTERS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()

_WORDED = (K.ALNUM_WORD[K.lower_ascii(np.arange(256, dtype=np.uint8))]).astype(np.uint8)


def _line_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where lines start, but for empty last ones."""
    start = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
    return start[start < len(data)]


class LineReader:
    """Lines, their words and their 128-bit hashes, for slices of a text column."""

    def __init__(self):
        self.values, self.chars = K.byte_values(), K.Rolling()
        self.parts = [K.Rolling(0x9E3779B97F4A7C15), K.Rolling(0xD1342543DE82EF95)]

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Lines with words per row."""
        start = _line_starts(data, offsets)
        if not len(start):
            return np.zeros(len(offsets) - 1, np.int64)
        worded = np.maximum.reduceat(_WORDED[data], start).astype(bool)
        return K.counts(np.searchsorted(offsets[1:], start[worded], side="right"), len(offsets) - 1)

    def read(self, data: np.ndarray, offsets: np.ndarray):
        """(lower-cased bytes, word start, word end, word hash, line row, line number, first word, words, hash pair)."""
        low = K.lower_ascii(data)
        start, end = K.edges(K.ALNUM_WORD[low], offsets)
        word = K.mix(self.chars.load(self.values[low]).spans(start, end) ^ (end - start).astype(np.uint64))
        at = _line_starts(low, offsets)
        first = np.searchsorted(start, at)
        size = np.diff(np.append(first, len(start)))
        at, first, size = at[size > 0], first[size > 0], size[size > 0]
        row = np.searchsorted(offsets[1:], at, side="right")
        breaks = np.flatnonzero(low == 10)
        number = np.searchsorted(breaks, at) - np.searchsorted(breaks, offsets[row])
        pair = [K.mix(r.load(word).spans(first, first + size) ^ size.astype(np.uint64)) for r in self.parts]
        return low, start, end, word, row, number, first, size, np.stack(pair, axis=1)


def simhash_blocks(word: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(lines, KEYS) 32-bit keys: the SimHash blocks, then the keys of halves and quarters."""
    return np.concatenate([_majority_blocks(word, first, size), _part_keys(word, first, size)], axis=1)


def _part_keys(word: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(lines, KEYS - BLOCKS) hashes of the halves and quarters; an empty part has the hash of the whole line.

    Lines whose sizes differ by one have the same even or the same odd number of words in a half.
    """
    roll, ends, half = K.Rolling(0xA24BAED4963EE407).load(word), first + size, size // 2
    parts = []
    for odd in (0, 1):
        n = np.maximum(half - (half + odd) % 2, 0)
        parts += [(first, first + n, n), (ends - n, ends, n)]
    parts += [(first + size * k // 4, first + size * (k + 1) // 4, size) for k in range(4)]
    out = np.empty((len(first), KEYS - BLOCKS), np.uint32)
    for k, (a, b, n) in enumerate(parts):
        empty = a == b
        a, b = np.where(empty, first, a), np.where(empty, ends, b)
        out[:, k] = (K.mix(roll.spans(a, b) ^ K.mix(np.where(empty, -size, n).astype(np.uint64))) >> np.uint64(32)).astype(np.uint32)
    return out


#: Bits of a word's hash that the SimHash is made from; the rest of a 64-bit cell numbers the line.
_WORD_BITS = np.uint64(40)
_LINES = 1 << 24


#: Lines of up to this many distinct words are counted in binary digits, 64 counters to a number.
_SHORT = 127


def _short_majority(word: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The majority blocks of lines of 1 to _SHORT words: the k-th words of all lines are added at once, digit by digit."""
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    longer = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")  # lines of more than k words
    digits = [np.zeros((len(first), len(_SALTS)), np.uint64) for _ in range(int(size[0]).bit_length() if len(size) else 0)]
    bits = np.stack([K.mix(word + np.uint64(s)) for s in _SALTS], axis=1)
    for k, m in enumerate(longer):
        add = bits[first[:m] + k]
        for digit in digits[: (k + 1).bit_length()]:
            carry = digit[:m] & add
            digit[:m] ^= add
            add = carry
    # more than half: the count exceeds size // 2, compared from the highest digit
    more, even = np.zeros((len(first), len(_SALTS)), np.uint64), np.full((len(first), len(_SALTS)), ~np.uint64(0))
    for k in reversed(range(len(digits))):
        half = np.where(size // 2 >> k & 1, ~np.uint64(0), np.uint64(0))[:, None]
        more |= even & digits[k] & ~half
        even &= ~(digits[k] ^ half)
    out = np.empty((len(first), BLOCKS), np.uint32)
    out[order] = more.view(np.uint32)
    return out


def _majority_blocks(word: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(lines, BLOCKS) 32-bit blocks: the majority of each of 256 hash bits over a line's distinct words.

    A word counts once per line, or the frequent short words of a language would make its long lines alike.
    """
    if len(first) > _LINES:
        parts = [slice(i, i + _LINES) for i in range(0, len(first), _LINES)]
        return np.concatenate([_majority_blocks(word[first[p][0]: first[p][-1] + size[p][-1]], first[p] - first[p][0], size[p]) for p in parts])
    # a word is told by _WORD_BITS of its hash, beside its line: sorting values is much faster than sorting places
    cell = np.repeat(np.arange(len(first), dtype=np.uint64) << _WORD_BITS, size) | word & ((np.uint64(1) << _WORD_BITS) - np.uint64(1))
    cell.sort()
    cell = cell[np.concatenate([[True], cell[1:] != cell[:-1]])] if len(cell) else cell
    word, line_of = cell & ((np.uint64(1) << _WORD_BITS) - np.uint64(1)), (cell >> _WORD_BITS).astype(np.int64)
    size = np.bincount(line_of, minlength=len(first))
    first = np.cumsum(size) - size
    out = np.empty((len(first), BLOCKS), np.uint32)
    short = size <= _SHORT
    if short.any():
        out[short] = _short_majority(word, first[short], size[short])
    if not short.all():
        long = np.flatnonzero(~short)
        take = np.repeat(first[long] - (np.cumsum(size[long]) - size[long]), size[long]) + np.arange(size[long].sum())
        out[long] = _long_majority(word[take], np.cumsum(size[long]) - size[long], size[long])
    return out


def _long_majority(word: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The majority blocks of any lines, with a counter per bit; ``word`` holds the lines' words in order."""
    out = np.empty((len(first), BLOCKS), np.uint32)
    step = 1 << 11  # words expanded to 256 counters at a time: what a core's cache holds
    ends = first + size
    line = 0
    while line < len(first):
        stop = max(line + 1, int(np.searchsorted(ends, first[line] + step, side="right")))
        w = word[first[line]: ends[stop - 1]]
        raw = np.stack([K.mix(w + np.uint64(s)) for s in _SALTS], axis=1).view(np.uint8)
        # runs of at most 255 words of a line, so that one-byte counters, eight to a number, suffice
        at = first[line:stop] - first[line]
        runs = -(-size[line:stop] // 255)
        head = np.cumsum(runs) - runs
        cut = np.repeat(at, runs) + 255 * (np.arange(runs.sum()) - np.repeat(head, runs))
        counted = np.add.reduceat(_COUNTERS[raw], cut, axis=0).view(np.uint8)
        ones = counted.astype(np.int64) if len(cut) == len(at) else np.add.reduceat(counted, head, axis=0, dtype=np.int64)
        out[line:stop] = np.packbits(2 * ones > size[line:stop, None], axis=1).view(np.uint32)
        line = stop
    return out


def _lengths(low: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Characters of the normalised lines."""
    inner = np.flatnonzero((low & 0xC0) == 0x80)  # further bytes of a character; all of them belong to words
    total = np.concatenate([[0], np.cumsum(end - start)])
    further = np.searchsorted(inner, end[first + size - 1]) - np.searchsorted(inner, start[first])
    return total[first + size] - total[first] - further + size - 1


def _one_of_each(pair: np.ndarray, doc: np.ndarray, line: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, times) of each distinct pair of hashes: its first row by (doc, line), and the sum of ``times``."""
    order = np.lexsort((line, doc, pair[:, 1], pair[:, 0]))
    sorted_ = pair[order]
    new = np.flatnonzero(np.concatenate([[True], (sorted_[1:] != sorted_[:-1]).any(axis=1)])) if len(order) else order
    return order[new], np.add.reduceat(times[order], new) if len(new) else times[:0]


#: A distinct line as it travels: its hash, first place, number and keys.
_DISTINCT = np.dtype([("pair", "<u8", 2), ("doc", "<i8"), ("line", "<i4"), ("times", "<i8"), ("keys", "<u4", KEYS + 1)])
#: Lines whose keys are kept in one row.
_KEYED_ROWS = 1 << 14


def _merged(lines: np.ndarray) -> np.ndarray:
    """One record per distinct line."""
    at, times = _one_of_each(lines["pair"], lines["doc"], lines["line"], lines["times"])
    out = lines[at]
    out["times"] = times
    return out


def _cut_by(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds) of the rows of every bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    return order, np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)


def _occurrences(buckets: int):
    """One row per line with words, and per batch its distinct lines, dealt by hash."""

    def run(batches):
        reader = LineReader()
        for batch in batches:
            data, offsets = K.text_buffer(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = []
            for a, b in K.slices(offsets):
                low, start, end, word, row, number, first, size, pair = reader.read(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                if not len(row):
                    continue
                doc = ids[row + a]
                one, times = _one_of_each(pair, doc, number, np.ones(len(row), np.int64))
                at = np.argsort(one)
                one, times = one[at], times[at]
                lines = np.empty(len(one), _DISTINCT)
                lines["pair"], lines["doc"], lines["line"], lines["times"] = pair[one], doc[one], number[one], times
                # words of the chosen lines, gathered
                take = np.repeat(first[one] - (np.cumsum(size[one]) - size[one]), size[one]) + np.arange(size[one].sum())
                lines["keys"][:, :KEYS] = simhash_blocks(word[take], np.cumsum(size[one]) - size[one], size[one])
                lines["keys"][:, KEYS] = _lengths(low, start, end, first[one], size[one])
                found.append(lines)
                yield pa.RecordBatch.from_arrays(
                    [_fixed_binary(pair), pa.array(doc), pa.array(number.astype(np.int32)), pa.nulls(len(row), pa.int32()), pa.nulls(len(row), pa.binary())],
                    names=["sig", "doc_id", "line", "bucket", "payload"])
            if not found:
                continue
            lines = _merged(np.concatenate(found))
            bucket = (lines["pair"][:, 0] % np.uint64(buckets)).astype(np.int32)
            order, cut = _cut_by(bucket)
            lines, n = lines[order], len(cut) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(bucket[order][cut[:-1]]),
                 pa.array([lines[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary())],
                names=["sig", "doc_id", "line", "bucket", "payload"])

    return run


def _distinct_lines(table: pa.Table) -> pa.Table:
    """One row per distinct line of a bucket (hash, first place, number), and their keys, many lines to a row."""
    lines = _merged(np.concatenate([np.frombuffer(raw, _DISTINCT) for raw in table.column("payload").to_pylist()]))
    half = lines["pair"] * np.array([1, 0], np.uint64)  # only the first half of a hash goes with the keys
    parts = [slice(i, i + _KEYED_ROWS) for i in range(0, len(lines), _KEYED_ROWS)]
    n, m = len(lines), len(parts)
    names = ["sig", "doc_id", "line", "times", "halves", "keys"]
    return pa.concat_tables([
        pa.table([_fixed_binary(np.ascontiguousarray(lines["pair"])), pa.array(lines["doc"]), pa.array(lines["line"]), pa.array(lines["times"]),
                  pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=names),
        pa.table([pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()),
                  pa.array([half[p].tobytes() for p in parts], pa.binary()),
                  pa.array([lines["keys"][p].tobytes() for p in parts], pa.binary())], names=names)])


def _block_entries(buckets: int):
    """Keys of distinct lines, dealt by key; a line goes by the first half of its hash."""

    def run(batches):
        for batch in batches:
            for sigs, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):  # one or many lines
                keys = np.frombuffer(raw, np.uint32).reshape(-1, KEYS + 1)
                n = len(keys)
                column = np.tile(np.arange(KEYS, dtype=np.uint8), n)
                value, owner = keys[:, :KEYS].ravel(), np.repeat(np.arange(n), KEYS)
                length = np.minimum(keys[:, KEYS], LONGEST).astype(np.uint16)
                bucket = (K.mix(_list_key(column, value)) % np.uint64(buckets)).astype(np.int32)
                order, cut = _cut_by(bucket)
                column, value, owner, bucket = (c[order] for c in (column, value, owner, bucket))
                half, length = np.frombuffer(sigs, np.uint64)[::2][owner], length[owner]
                blobs = [half[i:j].tobytes() + value[i:j].tobytes() + length[i:j].tobytes() + column[i:j].tobytes()
                         for i, j in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]]), pa.array(blobs, pa.binary())], names=["bucket", "payload"])

    return run


def _list_key(column: np.ndarray, value: np.ndarray) -> np.ndarray:
    return column.astype(np.uint64) << np.uint64(32) | value.astype(np.uint64)


def _shared_blocks(table: pa.Table) -> pa.Table:
    """Entries of keys shared by lines that may be similar.

    An entry stays if the list has another of a length that 80 % similarity allows: a distance
    is at least the difference of the lengths, so this drops no link, whatever the list's size.
    """
    x, half, length = [], [], []
    for raw in table.column("payload").to_pylist():
        n = len(raw) // 15
        half.append(np.frombuffer(raw, np.uint64, n))
        length.append(np.frombuffer(raw, np.uint16, n, 12 * n))
        x.append(_list_key(np.frombuffer(raw, np.uint8, n, 14 * n), np.frombuffer(raw, np.uint32, n, 8 * n)))
    x, half, length = np.concatenate(x), np.concatenate(half), np.concatenate(length).astype(np.int64)
    order = np.lexsort((length, x))
    x, half, length = x[order], half[order], length[order]
    # the next longer line of the list is the likeliest
    near = (x[1:] == x[:-1]) & (100 * (length[1:] - length[:-1]) <= (100 - SIMILARITY_PERCENT) * length[1:])
    stay = np.concatenate([near, [False]]) | np.concatenate([[False], near])
    return pa.table([_fixed_binary(half[stay][:, None]), pa.array(x[stay].astype(np.int64))], names=["half", "x"])


def line_spans(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, line: np.ndarray):
    """(start, end, there, last) of numbered lines of rows, without their line breaks; ``there`` is false beyond a row's lines."""
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, offsets)
    breaks = np.append(breaks, len(data))
    count = (before[1:] - before[:-1])[row]
    there = line <= count
    at = before[row] + np.where(there, line, 0)
    start = np.where(line > 0, breaks[at - 1] + 1, offsets[row])
    end = np.where(line < count, breaks[at], offsets[row + 1])
    return start, end, there, line == count


def _inside(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in one of the spans, which do not overlap."""
    edge = np.zeros(n + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(data.tobytes())])


def _list_rows(column: pa.Array) -> np.ndarray:
    """The row of every element of a list column."""
    return np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))


def _wanted_lines(batches):
    """(sig, normalised line) of the asked lines with words of every text; ``asked`` holds line numbers in order."""
    reader = LineReader()
    for batch in batches:
        data, offsets = K.text_buffer(batch.column(0))
        row, line = _list_rows(batch.column(1)), batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        start, end, there, _ = line_spans(data, offsets, row, line)
        start, end = start[there], end[there]
        start, end = start[end > start], end[end > start]
        ends = np.concatenate([[0], np.cumsum(end - start)])
        picked = data[_inside(start, end, len(data))]
        for a, b in K.slices(ends):
            low, _, stop, _, _, _, first, size, pair = reader.read(picked[ends[a]: ends[b]], ends[a: b + 1] - ends[a])
            # words and, in the first byte after each but a line's last, a space
            inner = np.ones(len(stop), bool)
            inner[first + size - 1] = False
            keep = K.ALNUM_WORD[low]
            keep[stop[inner]] = True
            low[stop[inner]] = 32
            total = np.concatenate([[0], np.cumsum(keep)])
            text = _strings(low[keep], np.concatenate([[0], total[stop[first + size - 1]]]))
            yield pa.RecordBatch.from_arrays([_fixed_binary(pair), text.cast(pa.string())], names=["sig", "item"])


#: How far ahead, in words of both lines together, the word script looks for two equal words.
REACH = 6
#: (words of the left, words of the right) to pass over, few first, then those that exchange the most words.
_STEPS = sorted(((m, n) for m in range(REACH + 1) for n in range(REACH + 1 - m) if m + n), key=lambda s: (s[0] + s[1], abs(s[0] - s[1])))


def _words_within(left: list[str], right: list[str], allowed: int) -> bool:
    """Whether some way of exchanging, dropping and adding whole words takes at most ``allowed`` characters.

    Such a script is one way of editing, so its length is never below the edit distance.
    """
    i = j = 0
    while i < len(left) and j < len(right):
        if left[i] == right[j]:
            i, j = i + 1, j + 1
            continue
        for m, n in _STEPS:
            if i + m < len(left) and j + n < len(right) and left[i + m] == right[j + n]:
                break
        else:
            m, n = len(left) - i, len(right) - j
        gone, come = left[i: i + m], right[j: j + n]
        # without words on one side, a separator goes or comes with each word
        allowed -= max(sum(map(len, gone)) + m, sum(map(len, come)) + n) - (1 if m and n else 0)
        if allowed < 0:
            return False
        i, j = i + m, j + n
    rest = left[i:] or right[j:]
    return sum(map(len, rest)) + len(rest) <= allowed


def _allowed(a: str, b: str) -> int:
    return max(len(a), len(b)) * (100 - SIMILARITY_PERCENT) // 100


def _similar_by_words(a: str, b: str, allowed: int) -> bool:
    """Whether exchanging, dropping and adding whole words alone shows the lines to be similar."""
    left, right = a.split(" "), b.split(" ")
    if len(left) == len(right):  # exchanging the words that differ is one way of editing
        if sum(max(len(x), len(y)) for x, y in zip(left, right) if x != y) <= allowed:
            return True
    return _words_within(left, right, allowed)


def similar(a: str, b: str) -> bool:
    allowed = _allowed(a, b)
    return abs(len(a) - len(b)) <= allowed and (_similar_by_words(a, b, allowed) or edit_distance(a, b, allowed) <= allowed)


def _near(strings: Strings, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of lines, by number, are similar."""
    allowed = np.maximum(strings.size[left], strings.size[right]) * (100 - SIMILARITY_PERCENT) // 100
    return strings.within(left, right, allowed)


def _verify_pairs(left: list[str], right: list[str]) -> list[bool]:
    allowed = [_allowed(a, b) for a, b in zip(left, right)]
    out = np.array([abs(len(a) - len(b)) <= k and _similar_by_words(a, b, k) for a, b, k in zip(left, right, allowed)], bool)
    rest = np.flatnonzero(~out)
    items = [x for i in rest for x in (left[i], right[i])]
    if items:
        at = np.arange(0, len(items), 2)
        out[rest] = _near(Strings(items), at, at + 1)
    return out.tolist()


#: Cells that the pairs of neighbouring characters are counted in.
PAIR_CELLS = 256


def _may_be_similar(items: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of items the lengths and the counts of neighbouring characters leave possible.

    An edit changes the length by at most one and takes away at most two pairs of neighbours;
    cells that different pairs share only make the counts more alike, so no similar pair is lost.
    """
    size = np.array([len(x) for x in items], np.int64)
    code = np.frombuffer("".join(items).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(items)), size)
    cell = (K.mix(code[:-1].astype(np.uint64) << np.uint64(32) | code[1:]) % np.uint64(PAIR_CELLS)).astype(np.int64)
    inside = owner[1:] == owner[:-1]
    count = np.bincount(owner[:-1][inside] * PAIR_CELLS + cell[inside], minlength=len(items) * PAIR_CELLS)
    count = np.minimum(count, 255).astype(np.uint8).reshape(len(items), PAIR_CELLS)  # greater counts as this one keep more pairs
    allowed = np.maximum(size[left], size[right]) * (100 - SIMILARITY_PERCENT) // 100
    out = np.abs(size[left] - size[right]) <= allowed
    near = np.flatnonzero(out)
    for k in range(0, len(near), 4096):
        p = near[k: k + 4096]
        b = count[right[p]]
        out[p] = (np.maximum(count[left[p]], b) - b).sum(axis=1, dtype=np.uint32) <= 2 * allowed[p]
    return out


#: Pairs measured before components joined on the way are looked at.
ASKED_AT_ONCE = 4096


def _verify_block(items: list[str], component: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Verifies the asked pairs; components joined on the way are not compared again."""
    link = np.zeros(asked.shape, bool)
    root = list(range(len(items)))

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    left, right = np.nonzero(asked)
    likely = _may_be_similar(items, left, right)
    left, right, strings = left[likely], right[likely], Strings(items)
    component = component.tolist()
    for k in range(0, len(left), ASKED_AT_ONCE):
        i, j = left[k: k + ASKED_AT_ONCE], right[k: k + ASKED_AT_ONCE]
        now = np.array([find(c) for c in component])
        i, j = i[now[i] != now[j]], j[now[i] != now[j]]
        near = _near(strings, i, j)
        for x, y in zip(i[near].tolist(), j[near].tolist()):
            link[x, y] = True
            root[find(component[x])] = find(component[y])
    return link


#: Lines to verify are picked out by a broadcast list of places up to this many (a document's id and its line numbers), by a shuffle beyond.
BROADCAST_LINES = 2_000_000


def repeated_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, gone): per document the lines to remove, as (line number, first half of the line's hash)."""
    spark = documents.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = bounded(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    found = cut_lineage(docs.mapInArrow(_occurrences(buckets), "sig binary, doc_id long, line int, bucket int, payload binary"), "lines")
    seen = found.where("sig IS NOT NULL").select("sig", "doc_id", "line")
    told = cut_lineage(found.where("payload IS NOT NULL").select("bucket", "payload").repartition(buckets, "bucket").groupBy("bucket")
                       .applyInArrow(_distinct_lines, "sig binary, doc_id long, line int, times long, halves binary, keys binary"), "distinct-lines")
    distinct = told.where("sig IS NOT NULL").select("sig", F.struct("doc_id", "line").alias("first"), "times")
    entries = cut_lineage(told.where("keys IS NOT NULL").select("halves", "keys").mapInArrow(_block_entries(buckets), "bucket int, payload binary")
                          .repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_shared_blocks, "half binary, x long"), "entries")
    # lines with an equal half hash enter each other's lists, and are verified like any others
    wanted = cut_lineage(entries.select("half").distinct().join(
        distinct.select(F.substring("sig", 1, 8).alias("half"), "sig", "first"), "half"), "wanted-lines")
    entries = cut_lineage(entries.join(wanted.select("half", "sig"), "half").select("sig", "x"), "list-entries")
    # a line is normalised and hashed anew from its text, so rows of one id cannot exchange their lines
    places = wanted.groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.sort_array(F.collect_set("first.line")).alias("asked"))
    if wanted.count() <= BROADCAST_LINES:
        places = F.broadcast(places)
    items = docs.join(places, "doc_id").select("text", "asked").mapInArrow(_wanted_lines, "sig binary, item string")
    items = cut_lineage(items.join(wanted.select("sig"), "sig", "left_semi").dropDuplicates(["sig"]), "line-texts")
    groups = linked_components(entries.withColumn("band", F.lit(0)), items, _verify_pairs, _verify_block, by_list=True)
    groups = cut_lineage(groups.withColumnRenamed("node", "sig"), "line-groups")
    member = distinct.join(groups, "sig").select("sig", "component", "first")
    kept = member.select("sig", "component").join(member.groupBy("component").agg(F.min("first").alias("kept")), "component").select("sig", "kept")
    # a repeated line without a similar one is a group of its own
    alone = distinct.where("times > 1").join(groups, "sig", "left_anti").select("sig", F.col("first").alias("kept"))
    kept = kept.union(alone)
    gone = seen.select("sig", "doc_id", "line").join(kept, "sig").where("struct(doc_id, line) <> kept")
    return gone.select("doc_id", F.struct("line", "sig").alias("g")).groupBy("doc_id").agg(F.collect_set("g").alias("gone"))


def _without_lines(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, line: np.ndarray) -> pa.Array:
    """The texts without the given lines, and what is left joined by line breaks."""
    start, end, _, last = line_spans(data, offsets, row, line)
    keep = ~_inside(start, np.where(last, end, end + 1), len(data))
    # where the last line goes, so does the break after the last one that stays
    total = np.concatenate([[0], np.cumsum(keep)])
    some = row[last][total[offsets[row[last] + 1]] > total[offsets[row[last]]]]
    keep[np.flatnonzero(keep)[total[offsets[some + 1]] - 1]] = False
    total = np.concatenate([[0], np.cumsum(keep)])
    return _strings(data[keep], total[offsets])


def _apply(text_at: int, gone_at: int):
    """Per row of a batch: (lines with words, lines removed, new text)."""

    def run(batch: pa.RecordBatch):
        reader = LineReader()
        column, gone = batch.column(text_at).cast(pa.large_string()), batch.column(gone_at)
        data, offsets = K.text_buffer(column)
        total, removed = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        of, (line, sig) = _list_rows(gone), gone.flatten().flatten()
        line = line.to_numpy(zero_copy_only=False).astype(np.int64)
        sig = K.text_buffer(sig.cast(pa.large_binary()).view(pa.large_string()))[0].view(np.uint64).reshape(-1, 2)
        place, changed = np.arange(batch.num_rows), [column]
        done = batch.num_rows
        for a, b in K.slices(offsets):
            total[a:b] = reader.count(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
            i, j = np.searchsorted(of, [a, b])
            if i == j:
                continue
            rows, local = np.unique(of[i:j], return_inverse=True)
            d, o = K.text_buffer(column.take(pa.array(rows)))
            start, end, there, _ = line_spans(d, o, local, line[i:j])
            order = np.flatnonzero(there)[np.argsort(start[there], kind="stable")]
            ends = np.concatenate([[0], np.cumsum((end - start)[order])])
            picked = d[np.repeat(start[order] - ends[:-1], np.diff(ends)) + np.arange(ends[-1])]
            _, _, _, _, read, _, _, _, pair = reader.read(picked, ends)
            # rows of one id: a line goes only from the text that has it
            at = order[read][(pair == sig[i:j][order[read]]).all(axis=1)]
            gone_lines = np.unique(local[at] << 32 | line[i:j][at])
            row, number = gone_lines >> 32, gone_lines & 0xFFFFFFFF
            removed[rows] = K.counts(row, len(rows))
            changed.append(_without_lines(d, o, row, number))
            hit = np.flatnonzero(removed[rows])
            place[rows[hit]] = done + hit
            done += len(rows)
        return total, removed, pa.concat_arrays(changed).take(pa.array(place))

    return run


def _with_gone(documents: DataFrame) -> DataFrame:
    gone = repeated_lines(documents).withColumnRenamed("doc_id", "__doc_id").withColumnRenamed("gone", "__gone")
    return documents.join(gone, F.col("doc_id").cast("long") == F.col("__doc_id"), "left").drop("__doc_id")


def dedup_lines(documents: DataFrame, drop_emptied: bool = True) -> DataFrame:
    """The documents without the removed lines; ``drop_emptied`` leaves out those that lost all their lines with words."""
    marked = _with_gone(documents)
    text_at, gone_at = documents.columns.index("text"), len(documents.columns)
    apply = _apply(text_at, gone_at)
    sized = dict(documents.dtypes).get("n_chars") in ("int", "bigint")

    def run(batches):
        for batch in batches:
            total, removed, texts = apply(batch)
            columns = list(batch.columns[:gone_at])
            columns[text_at] = texts.cast(columns[text_at].type)
            if sized:
                at = batch.schema.names.index("n_chars")
                columns[at] = pc.if_else(pa.array(removed > 0), pc.utf8_length(texts).cast(columns[at].type), columns[at])
            kept = pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:gone_at])
            yield kept.filter(pa.array((total == 0) | (removed < total))) if drop_emptied else kept

    return marked.mapInArrow(run, documents.schema)


def line_report(documents: DataFrame) -> DataFrame:
    """Per row: lines with words, lines removed, and the SHA-256 of the remaining text."""
    import hashlib

    marked = _with_gone(documents.select("doc_id", "text"))
    apply = _apply(1, 2)

    def run(batches):
        for batch in batches:
            total, removed, texts = apply(batch)
            data, offsets = K.text_buffer(texts)
            digest = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total), pa.array(removed), pa.array(digest)],
                                             names=["doc_id", "n_lines", "n_removed", "kept_sha256"])

    marked = marked.withColumn("doc_id", F.col("doc_id").cast("long"))
    return marked.mapInArrow(run, "doc_id long, n_lines long, n_removed long, kept_sha256 string")
