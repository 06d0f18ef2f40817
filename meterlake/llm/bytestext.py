"""Hashes of all substrings and words of a batch of texts at once, with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Odd multipliers and a table of random values for bytes; any others do as well.
MULTIPLY, SCRAMBLE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
BYTE_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a text or binary column in a row, and each value's begin and length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.fill_null("" if pa.types.is_string(column.type) else b"").cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)
    if not len(wide):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return data[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0], np.diff(offsets)


def scramble(x: np.ndarray) -> np.ndarray:
    x = x * SCRAMBLE
    return x ^ (x >> np.uint64(32))


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each substring of ``size`` bytes, by its begin.

    Doubling: the hash of a substring is made of those of its halves, so later offsets'
    hashes are used again at every step.
    """
    known, done, out = BYTE_VALUES[data], 1, None
    rest, at = size, 0
    while True:
        if rest & done:
            part = known
            if out is None:
                out = part
            else:
                n = min(len(out), len(part) - at)
                out = scramble(out[: max(0, n)] * MULTIPLY + part[at : at + max(0, n)])
            at += done
        if 2 * done > rest:
            return out[: max(0, len(data) - size + 1)]
        known = scramble(known[:-done] * MULTIPLY + known[done:]) if len(known) > done else known[:0]
        done *= 2


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    out, done = values, 1
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:]) if len(out) > done else out[:0]
        done *= 2
    left = width - done
    return np.minimum(out[:-left], out[left:]) if left and len(out) > left else out[:0] if left else out


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z to a-z
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
POWER = np.uint64(0x5851F42D4C957F2D)
INVERSE = np.uint64(pow(int(POWER), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power_row(base: np.uint64, n: int) -> np.ndarray:
    key = int(base)
    if key not in _powers or len(_powers[key]) < n:
        row = np.full(max(n, 1 << 16), base, np.uint64)
        row[0] = 1
        _powers[key] = np.cumprod(row)
    return _powers[key][:n]


def word_bounds(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of bytes that are no white space, never across two texts."""
    inside = ~IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = begins[(lengths > 0)]
    first[starts] = inside[starts]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def range_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the given byte ranges."""
    if not len(data):
        return np.zeros(len(begin), np.uint64)
    sums = np.concatenate(
        (np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * _power_row(POWER, len(data))))
    )
    raw = (sums[end] - sums[begin]) * _power_row(INVERSE, len(data) + 1)[begin]
    return scramble(scramble(raw) + (end - begin).astype(np.uint64))


def shingle_sets(
    data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, words: int = 5
) -> list[np.ndarray]:
    """For each text its distinct word shingles as sorted 64-bit hashes, A-Z folded.

    A text of fewer words is one shingle, one without words has none.
    """
    data = FOLD[data]
    first, last = word_bounds(data, begins, lengths)
    hashes = range_hashes(data, first, last)
    low = np.searchsorted(first, begins)
    high = np.searchsorted(first, begins + lengths)
    combined = np.zeros(len(hashes), np.uint64)
    n = len(hashes) - words + 1
    if n > 0:
        acc = np.full(n, words, np.uint64)
        for j in range(words):
            acc = scramble(acc * MULTIPLY + hashes[j : j + n])
        combined[:n] = acc
    out = []
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(combined[a : b - words + 1]))
        elif b > a:
            acc = np.full(1, b - a, np.uint64)
            for j in range(a, b):
                acc = scramble(acc * MULTIPLY + hashes[j : j + 1])
            out.append(acc)
        else:
            out.append(combined[:0])
    return out
