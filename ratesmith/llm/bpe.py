"""BPE encoding and decoding by prefix-sharing trie traversal (operator 5).

The distinct new words of a slice of documents are inserted into a trie and the trie is
walked depth first.  A node stands for a prefix; its state is the *last token* of the
prefix's encoding and the depth where that token starts.  The last token of a prefix is the
one vocabulary token ending there whose predecessor's last token can stand before it (the
two, merged from their characters, stay two tokens).  So a prefix shared by many words is
encoded once, and a word's tokens are read off by following the states back from its end.

Work is per Spark task: a task keeps the encodings of the words it has met (at most
``CACHED_WORDS``, then it starts anew), so nothing is shuffled and nothing but the
vocabulary, a file of fixed size, is broadcast.

The normalisation, word pattern, end-of-word mark and special tokens are those of the
vocabulary file ``word_bpe_49k.json`` (NFC, white space to a space, lower case; letters,
single digits or runs of other characters).  Decoding joins the tokens' strings with spaces,
which is what the file's missing decoder means.

Defined cases: a null or empty text has no tokens and decodes to the empty text; repeated
rows and null ids are encoded row by row; long texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesmith.llm import kernels as K
from ratesmith.llm.batches import bounded

CACHED_WORDS = 300_000
WORD_END = "</w>"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Tokens and merges of a vocabulary file over a 512-letter alphabet.

    A token is a string of code points: a byte as itself, the last byte of a word as 256 + itself.
    """

    def __init__(self, spec: dict):
        shown = _byte_names()

        def letters(token: str) -> str:
            body = token.removesuffix(WORD_END)
            out = [shown[c] for c in body]
            if body != token:
                out[-1] += 256
            return "".join(map(chr, out))

        self.ids = {letters(t): i for t, i in spec["model"]["vocab"].items()}
        self.names = {i: t for t, i in spec["model"]["vocab"].items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {(letters(a), letters(b)): r for r, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        # every suffix of a token; the value is the token's id, or -1 if the suffix is no token
        self.suffixes: dict[str, int] = {}
        for token in self.ids:
            for k in range(len(token)):
                self.suffixes.setdefault(token[k:], -1)
        self.suffixes |= self.ids


def _byte_names() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TrieEncoder:
    """Depth-first traversal of the trie of a sorted list of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.rank, self.suffixes = vocabulary.rank, vocabulary.suffixes
        self.pairs: dict[tuple[str, str], bool] = {}
        self.computed = 0  # trie nodes whose state was computed

    def merged(self, text: str) -> list[str]:
        """Plain BPE of a short string: the best-ranked pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best: best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def follows(self, left: str, right: str) -> bool:
        """Whether the two tokens stay as they are side by side (an empty left: right alone)."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= 1_000_000:
                self.pairs.clear()
            known = self.merged(left + right) == ([left, right] if left else [right])
            self.pairs[left, right] = known
        return known

    def encode_sorted(self, words: list[str]):
        """(word, ids) of each word; ``words`` is sorted, so a trie branch is visited in one go."""
        path = [""]  # last token of the prefix of each depth; the root has none
        before = ""
        for word in words:
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del path[shared + 1:]
            for depth in range(shared + 1, len(word) + 1):
                path.append(self._last_token(word, depth, path))
            before = word
            ids, depth = [], len(word)
            while depth:
                ids.append(self.suffixes[path[depth]])
                depth -= len(path[depth])
            yield word, ids[::-1]

    def _last_token(self, word: str, depth: int, path: list[str]) -> str:
        self.computed += 1
        for start in range(depth - 1, -1, -1):
            suffix = word[start:depth]
            known = self.suffixes.get(suffix)
            if known is None:
                break  # no token ends in this, so none ends in anything longer
            if known >= 0 and self.follows(path[start], suffix):
                return suffix
        raise ValueError(f"no token ends {word[:depth]!r}")


# The word pattern of the vocabulary file, for any text and for ASCII text.
_ANY = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\r\f\va-z0-9]+"


class Splitter:
    """Normalises a text and cuts it into words; special tokens stand for themselves."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.any, self.ascii = regex.compile(_ANY).findall, re.compile(_ASCII).findall
        self.special = re.compile("|".join(f"({re.escape(s)})" for s in vocabulary.special))
        self.names = vocabulary.special

    def words(self, text: str) -> list[str]:
        if "<|" not in text:
            return self._plain(text)
        out: list[str] = []
        for part in self.special.split(text):
            if part:
                out += [part] if part in self.names else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text.lower())
        # lower case goes character by character: a final sigma is like any other
        return self.any(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


def _letters(word: str) -> str:
    raw = word.encode("utf-8")
    return raw[:-1].decode("latin-1") + chr(256 + raw[-1])


class Encoder:
    """Encodes the texts of a task; keeps the encodings of the words it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.trie, self.split = vocabulary, TrieEncoder(vocabulary), Splitter(vocabulary)
        self.special = {t: (i.to_bytes(4, "little"), t) for t, i in vocabulary.special.items()}
        self.known = dict(self.special)

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known = dict(self.special)
            new = words.difference(self.known)
        by_letters = {_letters(w): w for w in new}
        names = self.vocabulary.names
        for letters, ids in self.trie.encode_sorted(sorted(by_letters)):
            self.known[by_letters[letters]] = (b"".join(i.to_bytes(4, "little") for i in ids),
                                               " ".join(names[i] for i in ids))

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text."""
        split = [self.split.words(t) for t in texts]
        self._learn(set().union(*split))
        known = self.known
        out = []
        for words in split:
            got = [known[w] for w in words]
            out.append((b"".join([g[0] for g in got]), " ".join([g[1] for g in got])))
        return out


def load_vocabulary(path: str) -> dict:
    """The parsed vocabulary file (a local file of the driver)."""
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def default_vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _encoded(df: DataFrame, vocabulary_path: str | None, columns, schema: str) -> DataFrame:
    spark: SparkSession = df.sparkSession
    shared = spark.sparkContext.broadcast(load_vocabulary(vocabulary_path or default_vocabulary_path()))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        encoder = Encoder(Vocabulary(shared.value))
        for batch in batches:
            text = batch.column(1).cast(pa.large_string()).fill_null("")
            _, offsets = K.text_buffer(text)
            for a, b in K.slices(offsets):
                got = encoder.encode(text.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns(got)], names=names)

    return bounded(df).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def encode_documents(documents: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the token ids of every text, and the text they decode to."""
    import numpy as np

    return _encoded(documents, vocabulary_path, lambda got: [
        pa.array([np.frombuffer(g[0], "<u4").astype(np.int32) for g in got], pa.list_(pa.int32())),
        pa.array([g[1] for g in got], pa.string())], "doc_id long, ids array<int>, decoded string")


def encoding_digests(documents: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """Per document: number of tokens and SHA-256 of its ids and of its decoded text."""
    return _encoded(documents, vocabulary_path, lambda got: [
        pa.array([len(g[0]) // 4 for g in got], pa.int64()),
        pa.array([hashlib.sha256(g[0]).hexdigest() for g in got]),
        pa.array([hashlib.sha256(g[1].encode("utf-8")).hexdigest() for g in got])], SCHEMA)
