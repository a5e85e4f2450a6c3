"""Vectorised text work for Arrow batches: word bounds, word hashes and shingle hashes straight from UTF-8 buffers.

Nothing here builds a Python string for a word. Hashes are 64-bit: a polynomial over a table of
random byte values, then a finalising mix. Texts are handled in runs of about RUN bytes, so
that temporary arrays stay small; a longer text makes a run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import SPACE_BYTES

RUN = 1 << 20
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACE_BYTES)] = False
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = [np.uint64(x) for x in (_rng.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1))]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, RUN * 2)
        for i, base in enumerate((_P, _P_INVERSE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A finalising mix of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def packed(x: np.ndarray) -> bytes:
    """Integers from 0 as planes of bytes, the lowest first, as many as the largest needs; sparse planes compress well in a shuffle."""
    x = np.ascontiguousarray(x, np.uint64)
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes | pa.Buffer) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8)
    planes = planes[1:].reshape(planes[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.reshape(-1).view(np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets into them (nulls: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("") if column.null_count or not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, limit: int = RUN) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about `limit` bytes each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word of the concatenated texts, and for each text its first word's number (with an end)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = _IS_WORD[raw]
    first = np.empty(len(raw), bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    last = np.empty(len(raw), bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    edge = offsets[:-1][np.diff(offsets) > 0]
    first[edge] = True
    last[edge[1:] - 1] = True
    starts, ends = np.flatnonzero(first & inside), np.flatnonzero(last & inside) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words with A-Z in lower case."""
    up, down = _grown(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_LOWER[raw] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct k-word shingle hashes in rising order, concatenated, and the texts' offsets into them.

    A text of fewer than k words has its whole word sequence as one shingle; one without words has none.
    """
    starts, ends, at = word_bounds(raw, offsets)
    w = word_hashes(raw, starts, ends)
    n_words = np.diff(at)
    counts = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    out_at = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(out_at[-1], np.uint64)
    if len(w) >= k:
        full = np.zeros(len(w) - k + 1, np.uint64)
        for j in range(k):
            full += w[j : len(w) - k + 1 + j] * _STEP[j]
        full = mix(full)
        long_rows = n_words >= k
        place = np.ones(len(w), bool)
        for j in range(1, k):  # a shingle must not run over its text's end
            tails = at[1:][n_words >= j] - j
            place[tails] = False
        out_mask = np.repeat(long_rows, counts)
        out[out_mask] = full[place[: len(full)]]
    for i in np.flatnonzero((n_words > 0) & (n_words < k)):
        seq = w[at[i] : at[i + 1]]
        h = np.uint64(len(seq))
        for x in seq:
            with np.errstate(over="ignore"):
                h = np.uint64(h * _STEP[7] + x)
        out[out_at[i]] = mix(np.array([h], np.uint64))[0]
    for i in np.flatnonzero(counts > 1):
        out[out_at[i] : out_at[i + 1]].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[out_at[:-1][counts > 0]] = True
    totals = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], totals[out_at]
