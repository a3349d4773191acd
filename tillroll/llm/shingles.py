"""Word shingles of a batch of texts, hashed with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

K = 5  # words

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=_U)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = (np.ones(1, _U), np.ones(1, _U))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, dtype=_U)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers = tuple(tables)
    return _powers


def spans_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, the start and end of every word in them, and where each text starts (and the last ends).

    Words are `[^\\x20\\x09-\\x0D]+`. A null text has none.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    source = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    at = at - at[0]
    if not len(source):
        none = np.empty(0, np.int64)
        return source, none, none, at
    inside = ~_SPACE[source]
    fresh = np.zeros(len(source) + 1, dtype=bool)  # a text begins here
    fresh[at] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | fresh[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | fresh[1:-1]
    return source, np.flatnonzero(begins), np.flatnonzero(ends) + 1, at


def span_hashes(source: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans with A-Z lowered."""
    power, inverse = _power_tables(len(source))
    sums = np.zeros(len(source) + 1, _U)
    np.cumsum((_LOWER[source].astype(_U) + _U(1)) * power[: len(source)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of every text in order, and where each text's words start (and the last end)."""
    source, start, end, at = spans_of(texts)
    return span_hashes(source, start, end), np.searchsorted(start, at)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct K-word shingle hashes of each text.

    With fewer than K words the whole sequence is one shingle; without words there is none.
    """
    words, at = word_hashes(texts)
    if len(words) >= K:
        every = sum(words[j : len(words) - K + 1 + j] * _PLACES[j] for j in range(K))
        every = mix(every + _U(K))
    else:
        every = np.empty(0, _U)
    sets = []
    for a, b in zip(at.tolist(), at[1:].tolist()):
        n = b - a
        if n >= K:
            sets.append(np.unique(every[a : b - K + 1]))
        elif n:
            whole = (words[a:b] * _PLACES[:n]).sum(dtype=_U, keepdims=True)
            sets.append(mix(whole + _U(n)))
        else:
            sets.append(np.empty(0, _U))
    return sets


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the set, as two signed numbers."""
    a = mix(shingles).sum(dtype=_U)
    b = mix(shingles ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U)
    return tuple(int(x) for x in np.array([a, b], dtype=_U).view(np.int64))
