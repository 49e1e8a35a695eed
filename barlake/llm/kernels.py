"""Numpy kernels over Arrow text columns: hashed words and word shingles.

Words are runs of bytes that are no separators. All separators used here are
ASCII, so a UTF-8 text can be cut byte by byte and no code point is split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_CODE = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_CODE = _BYTE_CODE[_FOLD]

SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Everything in ASCII but digits and letters.
NON_WORD = np.zeros(256, bool)
NON_WORD[:128] = True
NON_WORD[48:58] = NON_WORD[65:91] = NON_WORD[97:123] = False

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            size = max(n, 1 << 16)
            _powers = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, _BASE)]))
            _inverses = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, _INVERSE)]))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser; ``salt`` gives independent ones."""
    with np.errstate(over="ignore"):
        x = x + _U((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, byte offsets of the rows) of parts of about
    SLICE_BYTES; a longer row is a part of its own. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """Start and end of each word and, per row, the number of its first word."""
    inside = ~separators[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    start[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word with A-Z lower-cased."""
    _grow(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, _U), np.cumsum(_CODE[data] * _powers[:len(data)])])
        return mix((total[ends] - total[starts]) * _inverses[starts], 1)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int):
    """Hash of each k-word shingle, its row and its first word's number. A row
    of 1 to k-1 words gives one shingle of all its words."""
    n = np.diff(first)
    with np.errstate(over="ignore"):
        out = np.zeros(max(len(words) - k + 1, 0), _U)
        for j in range(k):
            out = out * _BASE + words[j:j + len(out)]
        rows = np.repeat(np.arange(len(n)), np.maximum(n - k + 1, 0))
        within = np.arange(len(rows)) - np.repeat(
            np.concatenate([[0], np.cumsum(np.maximum(n - k + 1, 0))])[:-1], np.maximum(n - k + 1, 0))
        at = first[:-1][rows] + within
        hashes = mix(out[at], k)
        short = np.flatnonzero((n > 0) & (n < k))
        if len(short):
            whole = np.zeros(len(short), _U)
            for j in range(k - 1):
                has = n[short] > j
                whole[has] = whole[has] * _BASE + words[first[short[has]] + j]
            whole = mix(whole, 100 + k) ^ n[short].astype(_U)
            rows = np.concatenate([rows, short])
            at = np.concatenate([at, first[short]])
            hashes = np.concatenate([hashes, whole])
            order = np.argsort(rows, kind="stable")
            rows, at, hashes = rows[order], at[order], hashes[order]
    return hashes, rows, at
