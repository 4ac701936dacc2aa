"""Word shingles of whole texts as 64-bit hashes, vectorised over Arrow batches.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's hash is a
polynomial over random byte values, read off prefix sums of the whole buffer;
a shingle's hash is a mixed linear form of its words' hashes. A text with
fewer words than a shingle has gives its whole sequence as one shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from sheetlake.llm.common import blocks, fmix64, text_buffer

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _byte_values() -> np.ndarray:
    values = fmix64(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
    values[65:91] = values[97:123]  # A-Z count as a-z
    return values


_VALUES = _byte_values()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(0, np.uint64), np.ones(0, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        with np.errstate(over="ignore"):
            _powers = tuple(
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64),
                                                       np.full(size - 1, b & (2**64 - 1), np.uint64)]))
                for b in (_BASE, pow(_BASE, -1, 2**64)))
    return _powers


def words(raw: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block of texts and their offsets per text.
    ``outside`` marks the byte values that separate words."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~outside[raw]
    breaks = np.zeros(len(raw) + 1, dtype=bool)
    breaks[offsets] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | breaks[:-1]))
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | breaks[1:])) + 1
    power, inverse = _power_tables(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[raw] * power[:len(raw)], out=prefix[1:])
    hashes = fmix64((prefix[ends] - prefix[starts]) * inverse[starts])
    return hashes, np.searchsorted(starts, offsets, side="left")


def shingle_block(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text of a block, and offsets."""
    hashes, bounds = words(raw, offsets)
    counts = np.diff(bounds)
    per_text = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(per_text)])
    multipliers = fmix64(np.arange(1, size + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)) | _U(1)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    first = np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], per_text) + np.repeat(bounds[:-1], per_text)
    full = padded[:len(hashes)] * multipliers[0]
    for j in range(1, size):
        full = full + padded[j:j + len(hashes)] * multipliers[j]
    out = full[first]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        w = hashes[bounds[i]:bounds[i + 1]]
        out[out_bounds[i]] = (w * multipliers[:len(w)]).sum(dtype=np.uint64) + _U(len(w))
    out = fmix64(out)
    for a, b in zip(out_bounds[:-1], out_bounds[1:], strict=True):
        out[a:b].sort()
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = out[1:] != out[:-1]
    keep[out_bounds[:-1][per_text > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[out_bounds]
    return out[keep], kept


def shingle_sets(texts: pa.Array, size: int):
    """Yield (first row, sorted distinct shingle hashes, offsets) by blocks of rows."""
    raw, offsets = text_buffer(texts)
    for a, b in blocks(offsets, BLOCK_BYTES):
        yield a, *shingle_block(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], size)
