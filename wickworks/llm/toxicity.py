"""Toxicity: a linear-chain conditional random field tags toxic spans, and its marginals make document scores.

Tokens are runs of letters and digits in small letters. Labelled tokens come from labelled documents: words and beginnings of longer
words that stand in toxic documents and in next to no others, or in a share of the toxic ones that is many times that of the others (labels
err), are picked greedily, each for the toxic documents that those before it leave unexplained; then those join that mark nearly as many
toxic documents as the strongest, explained or not. If none qualifies, the words that tell toxic documents best serve. Tokens that have
one of these are labelled toxic. The field has two states; it is trained on chains of at most CHAIN
tokens by gradient ascent on its likelihood, with features of the token, its beginnings and end and its neighbours, hashed. Scoring
runs forward and backward over all chains of a batch at once. A document's score is a calibrated function of its highest marginal
and of the number of toxic tokens expected; tokens with a marginal of half or more make the offending spans.

Training takes at most max_rows labelled documents, first by a hash of their ids. Null text is empty; texts without tokens get the
score of no evidence. Rows are scored one by one; with no words in documents labelled toxic every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm import textbytes as tb
from wickworks.llm.common import held_out
from wickworks.llm.quality import sample

CHAIN = 64
#: Bytes of the beginnings of longer tokens that are features.
BEGINNINGS = (4, 5, 6, 7, 8)


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    max_rows: int = 6000
    epochs: int = 6
    rate: float = 0.5
    l2: float = 1e-5
    clean_chains: int = 4  # for each chain with a toxic token
    least_gain: int = 3  # documents that a word must explain
    most_clean: float = 0.0005  # share of clean documents that may have it,
    ratio: float = 25.0  # or its share of toxic documents is so many times that
    alike: float = 0.5  # words join that mark this share of what the strongest marks
    at_least: int = 4  # words that serve where none qualifies


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # by hashed feature; place 0 is no feature
    edges: np.ndarray  # 2 x 2 potentials' logarithms, from and to
    start: float
    calibration: np.ndarray


_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """The bytes in small letters, and the starts, ends and texts of the tokens."""
    low = _LOW[data]
    if len(low):
        capital = (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)
        low[1:][capital] += 0x20
    starts, ends = tb.runs(_INSIDE[low], offsets)
    return low, starts, ends, tb.texts_of(offsets, starts)


def _own(low, starts, ends) -> list[np.ndarray]:
    """Hashes of a token itself and of its beginnings; 0 where it is no longer."""
    out = [tb.mix(tb.spans_hash(low, starts, ends), 20)]
    for k in BEGINNINGS:
        long = ends - starts > k
        out.append(np.where(long, tb.mix(tb.spans_hash(low, starts, np.where(long, starts + k, ends)), 20 + k), np.uint64(0)))
    return out


def _features(low, starts, ends, of, bits: int) -> np.ndarray:
    """Places of each token's features, a row for each token."""
    own = _own(low, starts, ends)
    last = tb.mix(tb.spans_hash(low, np.maximum(starts, ends - 4), ends), 30)
    word = own[0]
    before, after = np.zeros_like(word), np.zeros_like(word)
    if len(of) > 1:
        together = of[1:] == of[:-1]
        before[1:] = np.where(together, tb.mix(word[:-1], 31), np.uint64(0))
        after[:-1] = np.where(together, tb.mix(word[1:], 32), np.uint64(0))
    found = np.stack([*own, last, before, after], axis=1)
    return np.where(found == 0, 0, 1 + (found % np.uint64((1 << bits) - 1)).astype(np.int64))


def _chains(of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and place of each token in the matrix of chains, and the number of chains."""
    counts = np.bincount(of, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(of)) - first[of]
    rows = -(-counts // CHAIN)
    base = np.concatenate([[0], np.cumsum(rows)])
    return base[of] + place // CHAIN, place % CHAIN, int(base[-1])


def marginals(emission: np.ndarray, length: np.ndarray, edges: np.ndarray, start: float, wanted: bool = True):
    """Forward and backward over chains: P(toxic) of each place, and the expected counts of the four edges.

    emission is (chains, places), the logarithm of the toxic state's potential over the clean one's. Messages are scaled to sum to 1.
    """
    n, width = emission.shape
    e, t = np.exp(np.clip(emission, -30, 30)), np.exp(edges)
    ahead, back = np.empty((width, 2, n)), np.ones((width, 2, n))
    a0, a1 = np.ones(n), np.exp(start) * e[:, 0]
    for k in range(width):
        if k:
            p0, p1 = ahead[k - 1]
            a0, a1 = p0 * t[0, 0] + p1 * t[1, 0], (p0 * t[0, 1] + p1 * t[1, 1]) * e[:, k]
        total = a0 + a1
        ahead[k, 0], ahead[k, 1] = a0 / total, a1 / total
    counts = np.zeros((2, 2))
    for k in range(width - 2, -1, -1):
        b0, b1 = back[k + 1, 0], back[k + 1, 1] * e[:, k + 1]
        c0, c1 = t[0, 0] * b0 + t[0, 1] * b1, t[1, 0] * b0 + t[1, 1] * b1
        total = c0 + c1
        live = k + 1 < length
        back[k, 0], back[k, 1] = np.where(live, c0 / total, 1.0), np.where(live, c1 / total, 1.0)
        if wanted:
            joint = np.stack([ahead[k, 0] * t[0, 0] * b0, ahead[k, 0] * t[0, 1] * b1, ahead[k, 1] * t[1, 0] * b0, ahead[k, 1] * t[1, 1] * b1])
            counts += np.where(live, joint / joint.sum(axis=0), 0.0).sum(axis=1).reshape(2, 2)
    p = ahead * back
    return (p[:, 1] / (p[:, 0] + p[:, 1])).T, counts


def _held(texts: pa.Array, among: np.ndarray | None = None):
    """(text, hash) of the distinct words and beginnings of each text, of those among a sorted array where one is given."""
    for row, data, offsets in tb.blocks(texts):
        low, starts, ends, of = _tokens(data, offsets)
        h, of = np.concatenate(_own(low, starts, ends)), np.tile(of + row, 1 + len(BEGINNINGS)).astype(np.uint64)
        keep = h != 0
        if among is not None and len(h):
            keep &= among[np.minimum(np.searchsorted(among, h), len(among) - 1)] == h
        order = np.lexsort((of[keep], h[keep]))
        h, of = h[keep][order], of[keep][order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
        yield of[first].astype(np.int64), h[first]


def _mark(texts: pa.Array, toxic: np.ndarray, s: Settings) -> np.ndarray:
    """Hashes of the words and beginnings that mark toxic documents."""
    found = list(_held(texts.filter(pa.array(toxic))))
    if not found or not toxic.any():
        return np.zeros(0, np.uint64)
    of, h = (np.concatenate(x) for x in zip(*found, strict=True))
    keys, back = np.unique(h, return_inverse=True)
    if not len(keys):
        return np.zeros(0, np.uint64)
    clean = np.zeros(len(keys), np.int64)
    for _, other in _held(texts.filter(pa.array(~toxic)), keys):
        clean += np.bincount(np.searchsorted(keys, other), minlength=len(keys))
    held, n_toxic, n_clean = np.bincount(back, minlength=len(keys)), max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    fit = (clean <= s.most_clean * n_clean) | (held / n_toxic >= s.ratio * clean / n_clean)
    strength = np.where(fit, held, 0)
    use = fit[back]
    back, of = back[use], of[use]
    picked = []
    while len(back):
        gain = np.bincount(back, minlength=len(keys))
        best = int(np.argmax(gain - 0.5 * (clean > 0)))
        if gain[best] < s.least_gain:
            break
        picked.append(best)
        left = ~np.isin(of, of[back == best])
        back, of = back[left], of[left]
    if picked:
        picked += np.flatnonzero(strength >= max(s.least_gain, s.alike * strength[picked].max())).tolist()
    else:
        lift = np.log((held + 0.5) / n_toxic) - np.log((clean + 0.5) / n_clean)
        picked = np.argsort(-lift * np.sqrt(held), kind="stable")[: s.at_least].tolist()
    return np.unique(keys[picked])


def train(texts: pa.Array, toxic: np.ndarray, s: Settings = Settings()) -> Model | None:
    """Labels tokens, fits the field and calibrates document scores; None if no toxic document has a word."""
    toxic = toxic > 0
    marks = _mark(texts, toxic, s)
    if not len(marks):
        return None
    rng = np.random.default_rng(7)
    feats, labels = [], []
    for row, data, offsets in tb.blocks(texts):
        low, starts, ends, of = _tokens(data, offsets)
        if not len(of):
            continue
        y = np.isin(np.stack(_own(low, starts, ends)), marks).any(axis=0) & toxic[of + row]
        r, c, n = _chains(of, len(offsets) - 1)
        f = np.zeros((n, CHAIN, 4 + len(BEGINNINGS)), np.int32)
        f[r, c] = _features(low, starts, ends, of, s.bits)
        m = np.full((n, CHAIN), -1, np.int8)
        m[r, c] = y
        has = (m == 1).any(axis=1)
        rest = np.flatnonzero(~has)
        take = np.concatenate([np.flatnonzero(has), rng.permutation(rest)[: s.clean_chains * int(has.sum()) + 2]])
        feats.append(f[take])
        labels.append(m[take])
    feats, labels = np.concatenate(feats), np.concatenate(labels)
    size = (1 << s.bits) + 1
    w, g2 = np.zeros(size), np.full(size, 1e-2)
    edges, start, e2 = np.zeros((2, 2)), -2.0, np.full((2, 2), 1.0)
    for _ in range(s.epochs):
        order = rng.permutation(len(feats))
        for at in range(0, len(order), 512):
            f, m = feats[order[at : at + 512]], labels[order[at : at + 512]]
            live, y = m >= 0, (m == 1).astype(float)
            p, counts = marginals(w[f].sum(axis=2), live.sum(axis=1), edges, start)
            d = np.where(live, y - p, 0.0)
            g = np.bincount(f.ravel(), weights=np.repeat(d.ravel(), f.shape[2]), minlength=size) / len(f) - s.l2 * w
            g[0] = 0
            g2 += g * g
            w += s.rate * g / np.sqrt(g2)
            both = live[:, 1:]
            seen = np.array([[(both & (y[:, :-1] == i) & (y[:, 1:] == j)).sum() for j in (0, 1)] for i in (0, 1)])
            ge = (seen - counts) / len(f)
            e2 += ge * ge
            edges = edges + 0.1 * s.rate * ge / np.sqrt(e2)
    model = Model(w.astype(np.float32), edges, start, np.zeros(3))
    x = np.concatenate([e for e, _ in _evidence(texts, model, s.bits)])
    c = np.zeros(3)
    for _ in range(50):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ c, -35, 35)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        c = c + np.linalg.solve(h, x.T @ (toxic - p) - 0.05 * c)
    return Model(model.weights, edges, start, c)


def _evidence(texts: pa.Array, model: Model, bits: int):
    """For each block: rows of (1, highest log-odds, log of the expected number of likely toxic tokens), and each text's spans."""
    for _, data, offsets in tb.blocks(texts):
        n = len(offsets) - 1
        low, starts, ends, of = _tokens(data, offsets)
        x = np.zeros((n, 3))
        x[:, 0], x[:, 1] = 1, -10
        spans: list[str] = [""] * n
        if len(of):
            r, c, rows = _chains(of, n)
            e = np.zeros((rows, CHAIN))
            e[r, c] = model.weights[_features(low, starts, ends, of, bits)].sum(axis=1)
            p, _ = marginals(e, np.bincount(r, minlength=rows), model.edges, model.start, wanted=False)
            p = p[r, c]
            np.maximum.at(x[:, 1], of, np.clip(np.log(np.maximum(p, 1e-12) / np.maximum(1 - p, 1e-12)), -10, 10))
            x[:, 2] = np.log1p(tb.sums(np.where(p >= 0.2, p, 0.0), of, n))
            at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            for i in np.flatnonzero(p >= 0.5).tolist():
                o = of[i]
                spans[o] += f"{',' if spans[o] else ''}{at[starts[i]] - at[offsets[o]]}:{at[ends[i]] - at[offsets[o]]}"
        x[:, 1] /= 5
        yield x, spans


def assess(texts: pa.Array, model: Model | None, bits: int = Settings.bits) -> pa.Array:
    """Score and spans (start:end in code points, comma-joined) of each text."""
    score, spans = [], []
    if model is None:
        score, spans = [0.0] * len(texts), [""] * len(texts)
    else:
        for x, s in _evidence(texts, model, bits):
            score += (1 / (1 + np.exp(-np.clip(x @ model.calibration, -35, 35)))).tolist()
            spans += s
    return pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array(spans, pa.string())], ["score", "spans"])


def assessed(text: Column, model: Model | None, bits: int = Settings.bits) -> Column:
    return F.arrow_udf(lambda texts: assess(texts, model, bits), "score double, spans string")(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending spans of every row."""
    texts, y = sample(docs, labels, "toxic", s.max_rows)
    model = train(texts, y, s)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), assessed(F.col("text"), model, s.bits).alias("v"))
    return found.select("doc_id", "held_out", F.col("v.score").alias("score"), (F.col("v.score") >= threshold).cast("int").alias("predicted"), F.col("v.spans").alias("spans"))
