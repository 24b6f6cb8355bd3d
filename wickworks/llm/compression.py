"""Quality rules: counts over words and lines, then bands on zstandard ratios of whole texts and fixed chunks.

Text that repeats itself compresses far better than prose, and random text far worse. How well prose compresses depends on its
length, so each limit holds for a range of sizes. A text is kept if it has enough words, not too many of them stand in repeated
windows, its whole ratio lies in its length's band, and no more than a share of its fixed chunks leave the chunks' band. The last chunk
ends where the text does and may overlap the one before it, so no byte of a text of a chunk or more is in none; a text shorter than a
chunk has only its whole ratio.

Null text counts as empty. An empty or blank text has no words, fails the base rules and isn't kept. Rows stay as they are: repeated
rows get equal results, and other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm import textbytes as tb

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Bands:
    """Limits by size: (bytes below, least ratio, most ratio) for whole texts in ascending order; chunks of chunk_bytes have one band."""

    whole: tuple[tuple[int, float, float], ...] = ((128, 0.8, 1.7), (256, 0.9, 1.9), (512, 1.0, 2.0), (1024, 1.1, 2.15), (2048, 1.25, 2.25), (4096, 1.4, 2.3), (8192, 1.5, 2.42), (16384, 1.6, 2.5), (65536, 1.6, 2.7), (1 << 62, 1.6, 3.0))
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (1.4, 2.6)
    max_bad_chunks: float = 0.25
    level: int = 3


PRODUCTION = Bands()

TYPE = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()), ("bad_chunks", pa.float64())])
DDL = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, bad_chunks double"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it is found more than once, and whether it was found before."""
    order = np.argsort(keys, kind="stable")
    in_order = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = in_order[1:] == in_order[:-1]
    often, before = np.empty(len(keys), bool), np.empty(len(keys), bool)
    often[order], before[order] = same[:-1] | same[1:], same[:-1]
    return often, before


def _base(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    n = len(offsets) - 1
    starts, ends = tb.words(data, offsets)
    of = tb.texts_of(offsets, starts)
    n_words = np.bincount(of, minlength=n)[:n]
    at = np.concatenate([[0], np.cumsum(~tb.SPACE[data] & ((data & 0xC0) != 0x80))])
    word_chars = at[offsets[1:]] - at[offsets[:-1]]
    at = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    n_symbols = at[offsets[1:]] - at[offsets[:-1]]

    line_starts, line_ends = tb.runs(data != 10, offsets)
    line_of = tb.texts_of(offsets, line_starts)
    full = np.concatenate([[0], np.cumsum(~tb.SPACE[data])])
    full = full[line_ends] > full[line_starts]
    line_starts, line_ends, line_of = line_starts[full], line_ends[full], line_of[full]
    _, before = _again(tb.pair(tb.spans_hash(data, line_starts, line_ends), line_of.astype(np.uint64)))
    n_dup_lines = np.bincount(line_of[before], minlength=n)[:n]

    n_repeat = np.zeros(n, np.int64)
    k = len(starts) - WINDOW + 1
    if k > 0:
        word = tb.spans_hash(data, starts, ends)
        window = tb.mix(of[:k].astype(np.uint64))
        for i in range(WINDOW):
            window = tb.pair(window, word[i : k + i])
        whole = of[:k] == of[WINDOW - 1 :]
        at = np.flatnonzero(whole)
        often, _ = _again(window[at])
        step = np.zeros(len(starts) + 1, np.int64)
        np.add.at(step, at[often], 1)
        np.add.at(step, at[often] + WINDOW, -1)
        covered = np.cumsum(step[:-1]) > 0
        n_repeat = np.bincount(of[covered], minlength=n)[:n]
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat]


def assess(texts: pa.Array, bands: Bands = PRODUCTION) -> pa.Array:
    """The counts, the ratios and the verdict of each text, as an array of TYPE."""
    cols: list[list] = [[] for _ in range(9)]
    press = zstandard.ZstdCompressor(level=bands.level)
    for _, data, offsets in tb.blocks(texts):
        base = _base(data, offsets)
        ratios, bad, fit = [], [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            size = b - a
            raw = data[a:b].tobytes()
            ratio = size / len(press.compress(raw)) if size else 0.0
            out = n = 0
            at = list(range(0, size - bands.chunk_bytes + 1, bands.chunk_bytes))
            for i in at + [size - bands.chunk_bytes] * bool(at and size % bands.chunk_bytes):
                r = bands.chunk_bytes / len(press.compress(raw[i : i + bands.chunk_bytes]))
                out, n = out + (not bands.chunk[0] <= r <= bands.chunk[1]), n + 1
            share = out / n if n else 0.0
            low, high = next((x[1], x[2]) for x in bands.whole if size < x[0])
            ratios.append(ratio)
            bad.append(share)
            fit.append(low <= ratio <= high and share <= bands.max_bad_chunks)
        failed = (base[0] < MIN_WORDS) | (100 * base[4] > MAX_REPEAT_PERCENT * base[0])
        for c, v in zip(cols, [*base, failed, np.array(fit, bool) & ~failed, ratios, bad], strict=True):
            c.extend(v.tolist() if isinstance(v, np.ndarray) else v)
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, TYPE, strict=True)], fields=list(TYPE))


def assessed(text: Column, bands: Bands = PRODUCTION) -> Column:
    """assess() as a column."""
    return F.arrow_udf(lambda texts: assess(texts, bands), DDL)(text)


def keep(docs: DataFrame, bands: Bands = PRODUCTION) -> DataFrame:
    """The rows of docs whose text passes, with their own columns."""
    return docs.where(assessed(F.col("text"), bands)["kept"])


def report(docs: DataFrame, bands: Bands = PRODUCTION) -> DataFrame:
    """doc_id with the counts, the ratios and the verdict of every row."""
    return docs.select("doc_id", assessed(F.col("text"), bands).alias("v")).select("doc_id", "v.*")
