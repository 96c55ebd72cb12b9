"""64-bit hashes of words and of runs of words, many at a time."""

from __future__ import annotations

import numpy as np

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
#: Bytes hashed at a time.
SLICE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on every other (the finalizer of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U) * _ODD + U(seed)) | U(1)


def byte_table(seed: int, fold: bool) -> np.ndarray:
    """A number for each byte; with ``fold`` the same for A-Z and a-z; 0 for ASCII white space."""
    table = numbers(seed, 256)
    if fold:
        table[65:91] = table[97:123]
    table[_SPACE] = 0
    return table


def word_hashes(data: bytes, table: np.ndarray) -> np.ndarray:
    """A hash for each word (run of bytes other than ASCII white space), which depends on its bytes and their places."""
    out = []
    at = 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        part = np.frombuffer(data, np.uint8, end - at, at)
        space = _SPACE[part]
        start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        if len(start):
            first = int(start[0])
            length = np.diff(np.append(start, len(part)))
            place = np.arange(first, len(part)) - np.repeat(start, length)
            powers = np.cumprod(np.concatenate([[U(1)], np.full(int(length.max()), U(0xD1342543DE82EF95))]))
            out.append(mix(np.add.reduceat(table[part[first:]] * powers[place], start - first)))
        at = end
    return np.concatenate(out) if out else np.empty(0, U)


def run_hashes(words: np.ndarray, size: int, factors: np.ndarray) -> np.ndarray:
    """A hash for each run of ``size`` words."""
    n = len(words) - size + 1
    if n < 1:
        return np.empty(0, U)
    total = np.zeros(n, U)
    for k in range(size):
        total += words[k : k + n] * factors[k]
    return mix(total)


def rolling_hashes(words: np.ndarray, size: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """As ``run_hashes``, for long runs: a polynomial by differences of prefix sums, in two steps whatever ``size`` is."""
    n = len(words) - size + 1
    if n < 1:
        return np.empty(0, U)
    inverse = U(pow(base, -1, 1 << 64))
    up = np.cumprod(np.concatenate([[U(1)], np.full(len(words) - 1, U(base))]))
    down = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, inverse)]))
    sums = np.concatenate([[U(0)], np.cumsum(words * up)])
    return mix((sums[size:] - sums[:n]) * down)
