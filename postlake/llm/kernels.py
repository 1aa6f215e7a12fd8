"""Hashes of words and byte runs of many texts at once, in numpy; the work of one task step."""

from __future__ import annotations

import numpy as np

_M = (1 << 64) - 1
#: Odd multiplier of the polynomial hash modulo 2^64 and its inverse.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes that are hashed together; words and runs never cross such a block unless they are longer.
BLOCK = 1 << 19


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (a multiply and shift finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: A random-looking 64-bit value for each byte.
TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, up to n."""
    global _powers, _inverses
    while len(_powers) < n:
        size = len(_powers)
        _powers = np.concatenate([_powers, _powers * np.uint64(pow(BASE, size, 1 << 64))])
        _inverses = np.concatenate([_inverses, _inverses * np.uint64(pow(_INVERSE, size, 1 << 64))])
    return _powers, _inverses


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true in the given inclusive ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Space and the control characters from tab to carriage return.
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Everything in ASCII but digits and letters.
PUNCTUATION = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
NOT_LETTERS = byte_set((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray, gaps: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word: maximal runs of bytes outside gaps. The last byte of data must be a gap."""
    table = TABLE[LOWER] if lower else TABLE
    hashes, starts, ends, at = [], [], [], 0
    cuts = np.flatnonzero(gaps[data]) if len(data) > BLOCK else None
    while at < len(data):
        end = len(data)
        if end - at > BLOCK:
            i = np.searchsorted(cuts, at + BLOCK)
            end = int(cuts[i - 1] + 1) if i and cuts[i - 1] >= at else int(cuts[i] + 1)
        block = data[at:end]
        inside = np.zeros(len(block) + 2, np.int8)
        inside[1:-1] = ~gaps[block]
        edge = np.diff(inside)
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = _grown(len(block) + 1)
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(table[block] * power[: len(block)], out=sums[1:])
        hashes.append(mixed((sums[b] - sums[a]) * inverse[a]))
        starts.append(a + at)
        ends.append(b + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def run_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash of every n neighbouring 64-bit values, by prefix sums; len(values) - n + 1 entries."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out = []
    for at in range(0, len(values) - n + 1, BLOCK):
        part = values[at : at + BLOCK + n - 1]
        power, inverse = _grown(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * power[: len(part)], out=sums[1:])
        out.append(mixed((sums[n:] - sums[:-n]) * inverse[: len(part) - n + 1]))
    return np.concatenate(out)


def minimum_places(hashes: np.ndarray, n: int) -> np.ndarray:
    """For every n neighbouring hashes the place of the smallest (by its upper 40 bits, leftmost on ties)."""
    if len(hashes) < n:
        return np.zeros(0, np.int64)
    out, low = [], np.uint64((1 << 24) - 1)
    for at in range(0, len(hashes) - n + 1, BLOCK):
        part = hashes[at : at + BLOCK + n - 1]
        key = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while width * 2 <= n:  # smallest of `width` neighbours, doubled
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        rest = n - width
        if rest:
            key = np.minimum(key[:-rest], key[rest:])
        out.append((key & low).astype(np.int64) + at)
    return np.concatenate(out)
