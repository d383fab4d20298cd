"""Array kernels over the bytes of many texts at once; they run inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)
# Texts are worked on in slices of about this many bytes, so a task's memory does not grow with its input.
SLICE = 2 << 20

_values = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
BYTE_VALUES = _values | U64(1)
LOWER_VALUES = BYTE_VALUES[_lower]

NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# Of a lower-cased text: digits, letters and every byte of a character beyond ASCII.
WORD = np.ones(256, dtype=bool)
WORD[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i < n."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE + (SLICE >> 1))
        inverse = U64(pow(int(BASE), -1, 1 << 64))
        steps = np.full(size, BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
        steps[1:] = inverse
        _inverses = np.cumprod(steps, dtype=np.uint64)
    return _powers, _inverses


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal in, equal out; every bit depends on every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes, one row at least."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """c with c[b] - c[a] the polynomial hash of values[a:b] times BASE ** a."""
    p, _ = powers(len(values) + 1)
    c = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * p[: len(values)], out=c[1:])
    return c


def span_hash(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(c))
    return mixed((c[ends] - c[starts]) * inverse[starts])


def words(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and at[i] as a place among the words: row i has words first[i] to first[i + 1]."""
    flag = inside[data]
    n = len(flag)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(at), dtype=np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[at[at <= n]] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = flag[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = flag[1:]
    starts = np.flatnonzero(flag & (~before | edge[:-1]))
    ends = np.flatnonzero(flag & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def gram_hash(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place; len(word) - k + 1 of them."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total *= BASE
        total += word[j : j + n]
    return mixed(total + U64(k))


def shingles(data: np.ndarray, at: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes of each row, sorted, and their n + 1 offsets.

    Words are runs without white space, A-Z in lower case. Fewer than k words: the whole sequence is
    the one shingle. No words: none.
    """
    starts, ends, first = words(data, at, NOT_SPACE)
    word = span_hash(prefix_hash(LOWER_VALUES[data]), starts, ends)
    grams = gram_hash(word, k)
    out, counts = [], np.zeros(len(at), dtype=np.int64)
    for i in range(len(at) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= k:
            own = np.sort(grams[a : b - k + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) > 1 else own
        elif b > a:
            own = gram_hash(word[a:b], b - a)
        else:
            continue
        out.append(own)
        counts[i + 1] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)), np.cumsum(counts)


def gathered(parts: list, dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=dtype)


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow list column of longs."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))
