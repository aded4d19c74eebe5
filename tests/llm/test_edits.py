"""The batched edit distance against the one of single pairs."""

import random
import time

import numpy as np

from ratesmith.llm import lines
from ratesmith.llm.edits import Strings


def _variants(rng, letters, n):
    items = []
    for _ in range(n):
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 30, 63, 64, 65, 128, 200])))
        items.append(text)
        text = list(text)
        for _ in range(rng.choice([0, 1, 5, 30])):
            if text and rng.random() < 0.6:
                del text[rng.randrange(len(text))]
            if rng.random() < 0.6:
                text.insert(rng.randrange(len(text) + 1), rng.choice(letters))
        items.append("".join(text))
    return items


def test_batched_distances_are_those_of_single_pairs():
    rng = random.Random(3)
    for letters in ("ab ", "abcdéß 日\U0001f600"):
        items = _variants(rng, letters, 60)
        left, right = np.triu_indices(len(items))
        keep = (left // 2 == right // 2) | (np.arange(len(left)) % 7 == 0)
        left, right = left[keep], right[keep]
        allowed = np.array([rng.choice([0, 1, 3, 10, 60, lines._allowed(items[i], items[j])]) for i, j in zip(left, right)])
        expected = [lines.edit_distance(items[i], items[j]) <= k for i, j, k in zip(left, right, allowed)]
        assert Strings(items).within(left, right, allowed).tolist() == expected
        assert 0 < sum(expected) < len(expected)


def test_verified_pairs_are_the_similar_ones():
    rng = random.Random(5)
    items = ["".join(x) for x in _variants(rng, "abc de", 100)] + ["x" * 2000 + "y" * 300, "x" * 2000 + "z" * 300, "x" * 2000 + "z" * 700]
    pairs = [(a, b) for a in items[-43:] for b in items[-43:]]
    assert lines._verify_pairs([a for a, _ in pairs], [b for _, b in pairs]) == [lines.similar(a, b) for a, b in pairs]
    assert lines._verify_pairs([], []) == []


def test_a_block_joins_the_components_of_its_similar_lines():
    rng = random.Random(7)
    items = _variants(rng, "abcdefgh ", 40)
    asked = np.triu(np.ones((80, 80), bool), 1)
    link = lines._verify_block(items, np.arange(80), asked)

    def roots(pairs):
        root = list(range(80))
        for a, b in pairs:
            a, b = root[a], root[b]
            root = [min(a, b) if r in (a, b) else r for r in root]
        return root

    assert roots(zip(*np.nonzero(link))) == roots((i, j) for i in range(80) for j in range(i + 1, 80) if lines.similar(items[i], items[j]))


def test_a_block_of_lines_alike_by_half_is_measured_at_once():
    rng = random.Random(9)
    words = ["".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    half = [rng.choice(words) for _ in range(25)]
    items = [" ".join(half + [rng.choice(words) for _ in range(25)]) for _ in range(160)]
    asked = np.triu(np.ones((160, 160), bool), 1)
    began = time.process_time()
    single = [lines.similar(items[0], x) for x in items[1:]]
    one_by_one = (time.process_time() - began) * asked.sum() / len(single)
    began = time.process_time()
    link = lines._verify_block(items, np.arange(160), asked)
    assert time.process_time() - began < one_by_one / 2
    assert link[0, 1:].tolist() == single
