"""Vectorized word and window hashes of many texts at once (64-bit Rabin-Karp).

Values are polynomials modulo 2**64 over random tables: a prefix sum of
``value * base**position`` gives the hash of any slice as a difference times the
inverse power, so words and windows of words cost a few array operations per byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SEEDS = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _SEEDS.integers(1, 2 ** 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_SEEDS.integers(2 ** 40, 2 ** 62)) * 2 + 1
WORD_BASE = int(_SEEDS.integers(2 ** 40, 2 ** 62)) * 2 + 1
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection that spreads every bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (an odd base has an inverse)."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base % (1 << 64), inverse):
        p = np.full(n, b, np.uint64)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def groups(texts: list[str | None], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts as bytes) in groups of about ``most`` bytes; a text
    is never cut."""
    first, group, size = 0, [], 0
    for k, t in enumerate(texts):
        b = (t or "").encode()
        group.append(b)
        size += len(b)
        if size >= most:
            yield first, group
            first, group, size = k + 1, [], 0
    if group:
        yield first, group


def words(group: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, text number, start and end (in the group joined by spaces) of every word."""
    buf = np.frombuffer(b" ".join(group) + b" ", np.uint8)
    if lower:
        buf = _LOWER[buf]
    white = _WHITE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], white)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    power, inverse = powers(BASE, len(buf))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[buf] * power)))
    h = mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    sizes = np.array([len(t) + 1 for t in group])
    doc = np.searchsorted(np.cumsum(sizes), starts, "right")
    return h, doc, starts, ends


def windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every window of ``k`` words that lies in one text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    power, inverse = powers(WORD_BASE, len(h))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power)))
    first = np.flatnonzero(doc[:n] == doc[k - 1:])
    return mix64((total[first + k] - total[first]) * inverse[first]), first
