"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, scored as sparse dot products.

Features are words, word pairs, words' shapes (runs of capitals, small letters, digits and other characters), shape pairs and echoes
(which of the last two words a word repeats), hashed into one table of weights. Each kind has the mean over the text's words, so a
score doesn't depend on length. Only the text is read; labels serve to train.

Training takes a bounded sample, max_rows labelled rows in the order of a hash of their ids, which is all that reaches the driver.
Null text is empty and scores what the intercept says, as does any text without words. Rows are scored one by one, so repeated rows
score the same; no labels at all give 0.5 everywhere. Of several labels of one document the least counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm import textbytes as tb
from wickworks.llm.common import bounded_sample, held_out


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    max_rows: int = 6000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-3
    scale: float = 4.0


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 65, 97, 48, 97


def _ngrams(data: np.ndarray, offsets: np.ndarray):
    """(text, hash) arrays of each kind of feature."""
    starts, ends = tb.words(data, offsets)
    of = tb.texts_of(offsets, starts)
    word = tb.spans_hash(data, starts, ends)
    shape = _SHAPE[data]
    turn = np.ones(len(data), bool)
    turn[1:] = shape[1:] != shape[:-1]
    turn[starts] = True
    at = np.concatenate([[0], np.cumsum(turn)])
    form = tb.spans_hash(shape[turn], at[starts], at[ends])
    together = of[1:] == of[:-1]
    echo = np.zeros(len(of), np.uint64)
    echo[1:] += ((word[1:] == word[:-1]) & together).astype(np.uint64)
    echo[2:] += 2 * ((word[2:] == word[:-2]) & (of[2:] == of[:-2])).astype(np.uint64)
    yield of, tb.mix(word, 11)
    yield of, tb.mix(form, 12)
    yield of, tb.mix(echo, 13)
    yield of[1:][together], tb.pair(word[:-1], word[1:], 14)[together]
    yield of[1:][together], tb.pair(form[:-1], form[1:], 15)[together]


def _sparse(data: np.ndarray, offsets: np.ndarray, s: Settings):
    """(text, place, value) of all features of a block."""
    n = len(offsets) - 1
    for of, h in _ngrams(data, offsets):
        share = s.scale / np.maximum(1, np.bincount(of, minlength=n))
        yield of, (h & np.uint64((1 << s.bits) - 1)).astype(np.int64), share[of]


def rows(texts: pa.Array, s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, values) of each text."""
    out = []
    for _, data, offsets in tb.blocks(texts):
        of, place, value = (np.concatenate(x) for x in zip(*_sparse(data, offsets, s), strict=True))
        key, back = np.unique((of.astype(np.int64) << s.bits) | place, return_inverse=True)
        total = np.bincount(back, weights=value, minlength=len(key))
        cut = np.searchsorted(key >> s.bits, np.arange(len(offsets)))
        place = key & ((1 << s.bits) - 1)
        out += [(place[a:b], total[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return out


def train(texts: pa.Array, labels: np.ndarray, s: Settings = Settings()) -> np.ndarray:
    """Weights by FTRL-proximal, one update a text; the last weight is the intercept."""
    size = (1 << s.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    data = rows(texts, s)

    def weights(at):
        return np.where(np.abs(z[at]) <= s.l1, 0.0, -(z[at] - np.sign(z[at]) * s.l1) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2))

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for i in order.permutation(len(data)):
            at, x = np.append(data[i][0], size - 1), np.append(data[i][1], 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[i]) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha * w
            n[at] += g * g
    return weights(np.arange(size)).astype(np.float32)


def scores(texts: pa.Array, w: np.ndarray, s: Settings = Settings()) -> np.ndarray:
    out = np.zeros(len(texts))
    for row, data, offsets in tb.blocks(texts):
        n = len(offsets) - 1
        total = np.full(n, float(w[-1]))
        for of, place, value in _sparse(data, offsets, s):
            total += tb.sums(w[place] * value, of, n)
        out[row : row + n] = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
    return out


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> tuple[pa.Array, np.ndarray]:
    """Texts and labels of a bounded sample of documents that aren't held out."""
    texts, y = bounded_sample(docs, labels.where(~held_out(F.col("doc_id"))), label, max_rows)
    return texts, np.array(y, float)


def score(text: Column, w: np.ndarray, s: Settings = Settings()) -> Column:
    return F.arrow_udf(lambda texts: pa.array(scores(texts, w, s), pa.float64()), "double")(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    texts, y = sample(docs, labels, "quality", s.max_rows)
    w = train(texts, y, s)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), w, s).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
