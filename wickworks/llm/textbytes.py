"""Vectorised word handling over the UTF-8 bytes of an Arrow string array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The bytes that separate words: space and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text worked on at a time, so that the arrays made of them stay small whatever the batch.
BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 2 * BLOCK_BYTES)
        with np.errstate(over="ignore"):
            powers, inverses = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
            powers[0] = inverses[0] = 1
            _powers, _inverses = np.cumprod(powers), np.cumprod(inverses)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser, so that low bits depend on all."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((0x632BE59BD9B4E019 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of two hashes in order."""
    with np.errstate(over="ignore"):
        return mix(a * np.uint64(0xD6E8FEB86659FD93) + b, salt)


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about size bytes; nulls are empty texts; a longer text is a run alone."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        end = min(end, len(texts))
        yield row, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run ends where its text does."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no white space."""
    return runs(~SPACE[data], offsets)


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash, finalised, of each span of bytes; equal spans have equal hashes wherever they stand."""
    _grow(len(data) + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=prefix[1:])
        return mix((prefix[ends] - prefix[starts]) * _inverses[starts], 1) ^ mix((ends - starts).astype(np.uint64), 2)


def texts_of(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The text, counted within the block, that each span begins in."""
    return np.searchsorted(offsets, starts, "right") - 1


def sums(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Sums of values by text."""
    return np.bincount(of, weights=values, minlength=n)[:n]
