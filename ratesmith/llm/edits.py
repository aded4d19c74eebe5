"""Edit distances of many pairs of strings at once, against a limit for each pair.

The bit-parallel columns of ``edit_distance`` with an array of pairs in place of one: a
number of 64 rows of the matrix per pair and step, as many steps as the longer string has
characters left between the ends that both share.  A step costs the same for a few pairs as
for a hundred, so few pairs of a size are measured one by one, in numbers of as many bits.
"""

from __future__ import annotations

import numpy as np

#: Pairs whose ends are compared together, and whose columns are computed together.
PAIRS = 4096
#: So many pairs for each word of rows make computing them together cheaper than one by one.
LEAST = 100
#: Cells of the table of matches (pairs x characters x words of 64 rows) made at once.
CELLS = 1 << 22
#: Pairs that exceed their limit are left out every so many columns.
LOOK = 16


def edit_distance(a: str, b: str, limit: int | None = None) -> int:
    """Levenshtein distance: equal ends are stripped, the rest goes bit-parallel, one column per character of ``b``.

    With a ``limit`` it stops, with some greater number, once the distance must exceed it.
    """
    lo, most = 0, min(len(a), len(b))
    while lo < most and a[lo] == b[lo]:
        lo += 1
    a, b, most = a[lo:], b[lo:], most - lo
    hi = 0
    while hi < most and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[: len(a) - hi], b[: len(b) - hi]
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)  # +1 and -1 steps down a column
    left = len(b)
    for c in b:
        left -= 1
        match = at.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        right_up, right_down = down | (~(diagonal | up) & full), up & diagonal
        score += bool(right_up & top) - bool(right_down & top)
        right_up, right_down = (right_up << 1 | 1) & full, right_down << 1 & full
        up, down = right_down | (~(diagonal | right_up) & full), right_up & diagonal
        if limit is not None and score - left > limit:
            return score - left
    return score


class Strings:
    """Strings as one array of numbered characters."""

    def __init__(self, items: list[str]):
        self.items = items
        self.size = np.array([len(x) for x in items], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.chars, code = np.unique(np.frombuffer("".join(items).encode("utf-32-le"), np.uint32), return_inverse=True)
        self.code = code.astype(np.int64)

    def within(self, left: np.ndarray, right: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Whether the edit distance of each pair of strings (by number) is at most ``allowed``."""
        out = np.zeros(len(left), bool)
        for i in range(0, len(left), PAIRS):
            p = slice(i, i + PAIRS)
            out[p] = self._within(left[p], right[p], allowed[p])
        return out

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many characters from ``a`` and ``b`` on are the same, up to ``most``."""
        end = np.cumsum(most)
        begin = end - most
        k = step * (np.arange(end[-1] if len(end) else 0) - np.repeat(begin, most))
        differs = np.append(np.flatnonzero(self.code[np.repeat(a, most) + k] != self.code[np.repeat(b, most) + k]), end[-1:])
        return np.minimum(differs[np.minimum(np.searchsorted(differs, begin), len(differs) - 1)], end) - begin

    def _within(self, left, right, allowed) -> np.ndarray:
        a, b, m, n = self.start[left], self.start[right], self.size[left], self.size[right]
        out = np.abs(m - n) <= allowed
        ahead = self._common(a, b, np.minimum(m, n), 1)
        behind = self._common(a + m - 1, b + n - 1, np.minimum(m, n) - ahead, -1)
        a, b, m, n = a + ahead, b + ahead, m - ahead - behind, n - ahead - behind
        a, b, m, n = np.where(m <= n, a, b), np.where(m <= n, b, a), np.minimum(m, n), np.maximum(m, n)
        open_ = out & (m > 0) & (n > allowed)
        out &= open_ | (n <= allowed)
        words = -(-m // 64)
        for w in np.unique(words[open_]):
            p = np.flatnonzero(open_ & (words == w))
            if len(p) < LEAST * w:
                out[p] = [edit_distance(self.items[i], self.items[j], k) <= k for i, j, k in zip(left[p], right[p], allowed[p].tolist())]
                continue
            p = p[np.argsort(-n[p], kind="stable")]
            step = max(1, CELLS // (len(self.chars) * int(w)))
            for i in range(0, len(p), step):
                q = p[i: i + step]
                out[q] = self._columns(a[q], m[q], b[q], n[q], allowed[q], int(w))
        return out

    def _columns(self, a, m, b, n, allowed, words: int) -> np.ndarray:
        """Pairs of ``words`` words of rows, the longest ``n`` first."""
        pairs, kinds = len(a), len(self.chars)
        own, k = np.repeat(np.arange(pairs), m), np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        match = np.zeros(pairs * kinds * words, np.uint64)
        np.add.at(match, (own * kinds + self.code[a[own] + k]) * words + (k >> 6), np.uint64(1) << (k & 63).astype(np.uint64))
        match = match.reshape(pairs * kinds, words)
        out, alive = np.zeros(pairs, bool), np.arange(pairs)
        top, high, one = np.uint64(1) << ((m - 1) & 63).astype(np.uint64), np.uint64(63), np.uint64(1)
        up, down = [np.full(pairs, ~np.uint64(0)) for _ in range(words)], [np.zeros(pairs, np.uint64) for _ in range(words)]
        score = m.copy()
        for j in range(int(n[0])):
            if j % LOOK == 0 and j:
                stay = score - np.maximum(n - j, 0) <= allowed
                if stay.sum() < 0.8 * len(stay):
                    alive, b, n, allowed, score, top = (x[stay] for x in (alive, b, n, allowed, score, top))
                    up, down = [x[stay] for x in up], [x[stay] for x in down]
                    if not len(alive):
                        return out
            c = int(np.searchsorted(-n, -j, side="left"))  # pairs of more than j columns
            if not c:
                break
            found = match[alive[:c] * kinds + self.code[b[:c] + j]]
            carry, grown, shrunk = np.zeros(c, np.uint64), np.ones(c, np.uint64), np.zeros(c, np.uint64)
            for w in range(words):
                same, u, d = found[:, w], up[w][:c], down[w][:c]
                x = same & u
                total = x + u
                over = total < x
                total += carry
                carry = (over | (total < carry)).astype(np.uint64)
                diagonal = (total ^ u) | same | d
                right_up, right_down = d | ~(diagonal | u), u & diagonal
                if w == words - 1:
                    score[:c] += (right_up & top[:c]) != 0
                    score[:c] -= (right_down & top[:c]) != 0
                grown_out, shrunk_out = right_up >> high, right_down >> high
                right_up, right_down = right_up << one | grown, right_down << one | shrunk
                grown, shrunk = grown_out, shrunk_out
                up[w][:c], down[w][:c] = right_down | ~(diagonal | right_up), right_up & diagonal
        out[alive] = score <= allowed
        return out
