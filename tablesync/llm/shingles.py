"""Words and word shingles of Arrow string batches as 64-bit hashes, computed with numpy.

A word is a maximal run of bytes outside `\\x20\\x09-\\x0D`, A-Z lower-cased. A text's shingle set
holds the hashes of its distinct runs of `width` words; a text with fewer words (but at least one)
has one shingle, its whole sequence; a text without words, or null, has none.

Hashes stand for shingles: two different shingles of one pair of texts agree with a chance of 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are joined into chunks of about this many bytes; a longer text is one chunk

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, in place where possible."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd base modulo 2**64 and their inverses, grown to the longest chunk seen."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            inverse = pow(_BASE, -1, 1 << 64)
            powers = []
            for base in (_BASE, inverse):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = 1
                powers.append(np.multiply.accumulate(p))
            cls.up, cls.down = powers
        return cls.up, cls.down


def text_chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in them) of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1] or b"\0" * 8, dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts):
        return
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    if texts.null_count:
        present = np.asarray(texts.is_valid())
        lengths = np.where(present, np.diff(offsets), 0)
        if lengths.sum() != offsets[-1] - offsets[0]:
            kept = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
            yield from text_chunks(kept, most)
            return
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        last = min(max(last, row + 1), len(texts))
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of words before it (one more entry than texts)."""
    inside = ~_SPACE[data]
    n = len(data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < n]
    begins[firsts] = inside[firsts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    ends[lasts] = inside[lasts]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    up, down = _Powers.to(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_BYTE[_LOWER] if lower else _BYTE)[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(words: np.ndarray, before: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of each text in order, repeats included, and the offsets of the texts in them."""
    counts = np.diff(before)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    if not offsets[-1]:
        return np.zeros(0, dtype=np.uint64), offsets
    run = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for j in range(width):
        run += words[j : j + len(run)] * _PLACE[j]
    out = np.zeros(offsets[-1], dtype=np.uint64)
    long = counts >= width
    if long.any():
        at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes) + np.repeat(before[:-1], sizes)
        full = np.repeat(long, sizes)
        out[full] = run[at[full]]
    short = np.flatnonzero((counts > 0) & ~long)  # fewer words than a shingle has
    for i in short:
        w = words[before[i] : before[i + 1]]
        out[offsets[i]] = (w * _PLACE[: len(w)]).sum(dtype=np.uint64)
    out[offsets[short]] += _PLACE[32 + counts[short]]
    return mix(out), offsets


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, and the offsets of the texts in them."""
    values = values.copy()
    for a, z in zip(offsets[:-1], offsets[1:]):
        if z - a > 1:
            values[a:z].sort()
    if not len(values):
        return values, offsets
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[offsets[:-1][np.diff(offsets) > 0]] = True
    before = np.concatenate(([0], np.cumsum(new)))
    return values[new], before[offsets]


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, distinct shingles, offsets of the rows in them), chunk by chunk."""
    for first, last, data, offsets in text_chunks(texts):
        start, end, before = word_spans(data, offsets)
        values, at = shingles(word_hashes(data, start, end), before, width)
        yield first, last, *distinct(values, at)
