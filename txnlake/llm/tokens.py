"""Whole batches of texts as arrays of word hashes."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_RNG = np.random.default_rng(1)
#: A random 64-bit value for each byte; A-Z share the values of a-z.
_VALUE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))

#: The hash of the end token, which no word is likely to have.
END = _U(0xE57D00D5EED5)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        both = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            row = np.full(size, base, _U)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        _powers = (both[0], both[1])
    return _powers


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts in order (A-Z in lower case, split at white space),
    and the number of words of each text.

    A word's hash is the sum of its bytes' values times rising powers of an odd base, taken from running
    sums over the whole buffer.  Two different words of a corpus collide with a probability of about 2^-64."""
    raw = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    white = _IS_WHITE[raw]
    turn = np.flatnonzero(white[1:] != white[:-1]) + 1
    start, end = turn[0::2], turn[1::2]
    power, inverse = _base_powers(len(raw))
    sums = np.empty(len(raw) + 1, _U)
    sums[0] = 0
    np.cumsum(_VALUE[raw] * power[: len(raw)], out=sums[1:])
    found = mix((sums[end] - sums[start]) * inverse[start])
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return found, np.diff(np.searchsorted(start, bounds))


def count_words(texts: list[bytes]) -> int:
    white = _IS_WHITE[np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)]
    return int((white[:-1] & ~white[1:]).sum())


def sequences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts with the end token before and after each text, and the place of each text's first entry
    (and the end of the last)."""
    found, counts = word_hashes(texts)
    first = np.concatenate([[0], np.cumsum(counts + 2)]).astype(np.int64)
    out = np.full(first[-1], END, _U)
    inner = np.ones(len(out), bool)
    inner[first[:-1]] = False
    inner[first[1:] - 1] = False
    out[inner] = found
    return out, first
