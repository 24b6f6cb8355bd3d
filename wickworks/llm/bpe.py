"""Byte-level BPE by speculation: longest matches first, verified pair by pair, merged exactly only where the check fails.

A sequence of tokens is the encoding of a word if each token is the encoding of its own bytes and each adjacent pair is the encoding
of its bytes joined, because merges only ever look at neighbours. So a word's greedy longest-match tokens are proposed, all pairs
of all new words are checked at once against sorted arrays of pairs already known, unknown pairs are settled by merging those two
tokens' bytes, and a word with a failing pair is merged as a whole. Words already seen come from a cache of two bounded generations.

Null text is empty: no tokens, and the decoded text is empty. Very long words are merged with a heap, so no text is too long.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The pre-tokeniser's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII and Latin letters only, where the standard library's classes agree and are faster.
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
NOT_PLAIN = "[^\x00-\x1b\x20-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]"
CACHE_WORDS = 200_000
#: A word of more bytes goes straight to exact merging and isn't cached.
LONG_WORD = 256
#: Up to so many bytes merging scans instead of keeping a heap.
SHORT_WORD = 40
NO_MERGE = 1 << 62
#: Characters of text whose new words are learnt together.
PART_CHARS = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Coder:
    """Encodes and decodes with the vocabulary, merges and added tokens of a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        raw = lambda token: bytes(letters[c] for c in token)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.bytes = {i: b for b, i in self.ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.added.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            a, b = raw(a), raw(b)
            self.merges.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.decimal = {i: str(i) for i in self.bytes}
        self.ranks = {pair: rank << 32 | made for pair, (rank, made) in self.merges.items()}
        # By first two bytes, how long a token that begins with them can be: bounds the search for the longest match.
        self.reach: dict[bytes, int] = {}
        for t in self.ids:
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))
        self.whole = {i for i, b in self.bytes.items() if i not in self.added.values() and self.merge(b) == [i]}
        self.good = np.zeros(0, np.int64)
        self.bad = np.zeros(0, np.int64)
        self.split = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.find = regex.compile(PATTERN).findall
        self.find_plain, self.not_plain = re.compile(PLAIN_PATTERN).findall, re.compile(NOT_PLAIN).search
        # Two generations of words: when the younger is full it becomes the older, whose words come back as they are used.
        self.cache: dict[str, str] = {}
        self.older: dict[str, str] = {}
        # What the ids of a word decode to, where that isn't the word itself: the marks of added tokens.
        self.odd: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """The exact encoding of a word: always the adjacent pair of the least rank, the leftmost of equals."""
        ids = [self.single[b] for b in word]
        if len(ids) <= SHORT_WORD:
            return self._merge_short(ids)
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if m := self.merges.get((ids[i], ids[i + 1])):
                heap.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := self.merges.get((made, ids[k])):
                    heapq.heappush(heap, (m[0], i, made, ids[k], m[1]))
            h = before[i]
            if h >= 0 and (m := self.merges.get((ids[h], made))):
                heapq.heappush(heap, (m[0], h, ids[h], made, m[1]))
        return [x for x in ids if x >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        """merge() for few bytes, where a scan for the least rank is cheaper than a heap."""
        get = self.ranks.get
        found = [get(p, NO_MERGE) for p in zip(ids, ids[1:], strict=False)]
        while found and (best := min(found)) < NO_MERGE:
            i, made = found.index(best), best & 0xFFFFFFFF
            ids[i] = made
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = get((ids[i - 1], made), NO_MERGE)
            if i < len(found):
                found[i] = get((made, ids[i + 1]), NO_MERGE)
        return ids

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, n, ids, reach = [], 0, len(word), self.ids, self.reach
        while at < n:
            end = min(n, at + reach.get(word[at : at + 2], 1))
            while (t := ids.get(word[at:end])) is None:
                end -= 1
            out.append(t)
            at = end
        return out

    def _known(self, pairs: np.ndarray, among: np.ndarray) -> np.ndarray:
        if not len(among):
            return np.zeros(len(pairs), bool)
        at = np.minimum(np.searchsorted(among, pairs), len(among) - 1)
        return among[at] == pairs

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The encodings of words, which are speculated, verified together and merged exactly where they fail."""
        found = [self.propose(w) for w in words]
        sizes = np.array([len(t) for t in found], np.int64)
        flat = np.array([t for x in found for t in x], np.int64)
        of = np.repeat(np.arange(len(found)), sizes)
        fails = np.zeros(len(found), bool)
        if len(flat) > 1:
            inside = np.flatnonzero(of[:-1] == of[1:])
            pairs = flat[inside] * (1 << 32) + flat[inside + 1]
            distinct, place = np.unique(pairs, return_inverse=True)
            fine = self._known(distinct, self.good)
            new = np.flatnonzero(~fine & ~self._known(distinct, self.bad))
            for i in new:
                a, b = divmod(int(distinct[i]), 1 << 32)
                fine[i] = a in self.whole and b in self.whole and self.merge(self.bytes[a] + self.bytes[b]) == [a, b]
            self.good = np.union1d(self.good, distinct[new[fine[new]]])
            self.bad = np.union1d(self.bad, distinct[new[~fine[new]]])
            fails[of[inside[~fine[place]]]] = True
        alone = np.flatnonzero(sizes == 1)
        fails[[int(i) for i in alone if found[i][0] not in self.whole]] = True
        for i in np.flatnonzero(fails):
            found[i] = self.merge(words[i])
        return found

    def learn(self, words: set[str]) -> None:
        """Puts the decimal ids of words, joined by commas, in the cache, and decodes them to see whether that gives the word."""
        new = [w for w in words if w not in self.cache]
        raw = [w.encode() for w in new]
        short = [i for i, b in enumerate(raw) if len(b) <= LONG_WORD]
        ids: list[list[int]] = [[]] * len(new)
        for i, x in zip(short, self.encode_words([raw[i] for i in short]), strict=True):
            ids[i] = x
        for i, b in enumerate(raw):
            if len(b) > LONG_WORD:
                ids[i] = self.merge(b)
        decimal, raw_of = self.decimal, self.bytes
        for w, b, x in zip(new, raw, ids, strict=True):
            self.cache[w] = ",".join([decimal[t] for t in x])
            if (decoded := b"".join([raw_of[t] for t in x])) != b:
                self.odd[w] = decoded

    def pieces(self, text: str) -> list[str]:
        """A text's words, with the strings of added tokens as words of their own, marked by a leading NUL pair."""
        if not self.not_plain(text) and (self.split is None or not self.split.search(text)):
            return self.find_plain(text)
        if self.split is None:
            return self.find(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out += [*self.find(text[at : m.start()]), "\0\0" + m[0]]
            at = m.end()
        return out + self.find(text[at:])

    def code(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of tokens, decimal ids joined by commas, decoded text) of texts, whose new words are learnt together."""
        words = [self.pieces(t) for t in texts]
        wanted = set().union(*words)
        if len(self.cache) > CACHE_WORDS:  # what the last generation had and these texts use stays
            self.older, self.cache = self.cache, {}
        back = [w for w in wanted.difference(self.cache) if w in self.older]
        self.cache.update(zip(back, map(self.older.__getitem__, back), strict=True))
        missing = wanted.difference(self.cache)
        if missing:
            marks = {w for w in missing if w[:2] == "\0\0" and w[2:] in self.added}
            for w in marks:
                self.cache[w], self.odd[w] = str(self.added[w[2:]]), w[2:].encode()
            self.learn(missing - marks)
        out, ids_of, odd = [], self.cache.__getitem__, self.odd
        for x in words:
            ids = ",".join(map(ids_of, x))
            same = not odd or odd.keys().isdisjoint(x)
            decoded = "".join(x) if same else b"".join([odd[w] if w in odd else w.encode() for w in x]).decode("utf-8", "replace")
            out.append((ids.count(",") + 1 if ids else 0, ids, decoded))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder(name_or_path: str) -> Coder:
    """A worker's coder. A name without a slash is one of the installed public tokenizers' files."""
    if "/" not in name_or_path:
        import public_tokenizers

        name_or_path = str(public_tokenizers.path(name_or_path))
    return Coder(name_or_path)


def _parts(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in runs of about PART_CHARS characters, nulls as empty."""
    part, size = [], 0
    for t in texts:
        part.append(t.as_py() or "")
        size += len(part[-1])
        if size >= PART_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def coded(text: Column, vocabulary: str = "byte_bpe_50k.json", ids: bool = True) -> Column:
    """A struct of a text's n_tokens, ids_sha256 and decoded_sha256, and its token ids if asked for."""

    def run(texts: pa.Array) -> pa.Array:
        sha = hashlib.sha256
        counts, first, second, parts = [], [], [], []
        for part in _parts(texts):
            for n, text_ids, decoded in coder(vocabulary).code(part):
                counts.append(n)
                first.append(sha(text_ids.encode()).hexdigest())
                second.append(sha(decoded.encode()).hexdigest())
                if ids:
                    parts.append(np.fromstring(text_ids, np.int32, sep=",") if n else np.zeros(0, np.int32))
        cols, names = [pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"]
        if ids:
            flat = pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32))
            cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), flat))
            names.append("ids")
        return pa.StructArray.from_arrays(cols, names)

    return F.arrow_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids)(text)


def decode(ids: Column, vocabulary: str = "byte_bpe_50k.json") -> Column:
    """The text of an array of token ids; null ids give an empty text."""

    def run(arrays: pa.Array) -> pa.Array:
        return pa.array([coder(vocabulary).decode(x or []) for x in arrays.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(ids)


def digests(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id with the digests of the encoding and the decoding of every row."""
    return docs.select("doc_id", coded(F.col("text"), vocabulary, ids=False).alias("v")).select("doc_id", "v.*")


def encoded(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id with the token ids and the digests of every row."""
    return docs.select("doc_id", coded(F.col("text"), vocabulary).alias("v")).select("doc_id", "v.*")
