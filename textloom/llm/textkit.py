"""Vectorised byte and word kernels over batches of texts (numpy, no per-word Python).

A batch is ``(data, offsets)``: the UTF-8 bytes of all its texts end to end, and where
each begins.  Hashes are polynomials modulo 2**64 over an odd base, finished by a
64-bit mixer, so the hash of any span comes from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEPT = 1 << 21
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i up to n; kept between calls up to KEPT, not for longer texts."""
    if len(_powers[0]) > n:
        return _powers[0], _powers[1]
    a = np.empty((2, max(n + 1, 1 << 16)), np.uint64)
    a[0], a[1] = BASE, _INVERSE
    a[:, 0] = 1
    one, two = np.multiply.accumulate(a, axis=1, out=a)
    if n <= KEPT:
        _powers[:] = one, two
    return one, two


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def batches(column: pa.Array, most: int = 500_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, data, offsets) of slices of about ``most`` bytes; null texts are empty.

    A text longer than ``most`` makes a slice of its own; texts are never cut.
    """
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        b = min(b, len(column))
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def prefix_hash(data: np.ndarray) -> np.ndarray:
    p, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair; equal bytes give equal hashes."""
    _, inverse = powers(len(prefix))
    h = (prefix[end] - prefix[start]) * inverse[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, start, end) of each maximal run without white space."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    on = ~SPACE[data]
    full = np.flatnonzero(np.diff(offsets) > 0)
    before = np.empty(len(on), bool)
    before[0] = False
    before[1:] = on[:-1]
    before[offsets[full]] = False
    start = np.flatnonzero(on & ~before)
    after = np.empty(len(on), bool)
    after[-1] = False
    after[:-1] = on[1:]
    after[offsets[full + 1] - 1] = False
    end = np.flatnonzero(on & ~after) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, end


_STEPS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def shingles(text_of: np.ndarray, word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of each k-word window; a text of fewer words gives its whole sequence."""
    n = len(word)
    if not n:
        return text_of[:0], word[:0]
    top = int(text_of[-1]) + 1
    count = np.bincount(text_of, minlength=top)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    out_text, out_hash = [], []
    if n >= k:
        h = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            h += word[i : n - k + 1 + i] * _STEPS[i]
        same = text_of[: n - k + 1] == text_of[k - 1 :]
        out_text.append(text_of[: n - k + 1][same])
        out_hash.append(mix(h[same]))
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        h = np.zeros(len(few), np.uint64)
        for i in range(k - 1):
            there = count[few] > i
            h[there] += word[first[few[there]] + i] * _STEPS[i]
        out_text.append(few)
        out_hash.append(mix(h ^ (count[few].astype(np.uint64) << np.uint64(56)) ^ np.uint64(0x5851F42D4C957F2D)))
    return np.concatenate(out_text), np.concatenate(out_hash)


def distinct_per_text(text_of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, hash) pairs, sorted by text, then hash."""
    order = np.lexsort((h, text_of))
    t, h = text_of[order], h[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return t[new], h[new]
