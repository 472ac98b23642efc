"""Words and word shingles of whole texts, hashed over Arrow buffers without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes scanned at once; one longer text is scanned alone.
SCAN_BYTES = 1 << 20
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_RANDOM = np.random.default_rng(20240229)
_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
PLACES = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, base: int, n: int) -> np.ndarray:
    if kind not in _powers or len(_powers[kind]) < n:
        steps = np.full(max(n, SCAN_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at.astype(np.int64) - at[0]


def pieces(offsets: np.ndarray, limit: int = SCAN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def edges(raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each run of bytes that ``breaks`` does not list."""
    inside = ~breaks[raw]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    start[first] = inside[first]
    end[last] = inside[last]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offsets[1:], s, side="right")


def run_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each run ``raw[s:e]``; ``fold`` reads A-Z as a-z."""
    n = len(raw)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_FOLDED if fold else _VALUES)[raw] * _power("up", _BASE, n), out=sums[1:])
    return mix((sums[e] - sums[s]) * _power("down", pow(_BASE, -1, 2**64), n)[s])


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts: first text, text after the last, word hashes in order, and the text of each word."""
    raw, offsets = buffers(texts)
    for first, last in pieces(offsets):
        at = offsets[first : last + 1]
        part = raw[at[0] : at[-1]]
        if not len(part):
            yield first, last, np.zeros(0, np.uint64), np.zeros(0, np.int64)
            continue
        s, e, doc = edges(part, at - at[0])
        yield first, last, run_hashes(part, s, e), doc


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles.

    A text with fewer words gives its whole sequence as one; one without words, or null, gives none.
    """
    if not 1 <= width < len(PLACES):
        raise ValueError(f"width must be 1 to {len(PLACES) - 1}")
    for first, last, words, doc in word_hashes(texts):
        bounds = np.searchsorted(doc, np.arange(last - first + 1))
        rolled = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
        for k in range(width):
            rolled += words[k : k + len(rolled)] * PLACES[k]
        rolled = mix(rolled)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= width:
                yield np.unique(rolled[a : b - width + 1])
            elif b > a:
                short = np.append(words[a:b] * PLACES[: b - a], PLACES[b - a - 1 : b - a] * PLACES[-1:])
                yield mix(short.sum(keepdims=True, dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive word hashes; equal windows have equal hashes, the reverse is for the caller to confirm."""
    n = len(words)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * _power("up", _BASE, n), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * _power("down", pow(_BASE, -1, 2**64), n)[: n - width + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        done += step
    return values
