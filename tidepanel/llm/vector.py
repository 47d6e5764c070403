"""Array helpers for tasks that work on whole texts: words of a byte array, and their 64-bit hashes."""

from functools import cache

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64
SPACES = bytes([32, *range(9, 14)])  # fixed values: white space that ends a word


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@cache
def byte_values() -> np.ndarray:
    """A fixed random odd number for each byte."""
    return mixed((np.arange(256, dtype=_U) + _U(1)) * ODD) | _U(1)


_powers = np.ones(1, _U)
_inverses = np.ones(1, _U)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of a fixed odd number modulo 2**64, and their inverses."""
    global _powers, _inverses
    if len(_powers) <= n:
        base = 0xD1342543DE82EF95
        size = max(n + 1, 1 << 16)
        grown = np.full(size, base, _U)
        grown[0] = 1
        back = np.full(size, pow(base, -1, 1 << 64), _U)
        back[0] = 1
        _powers, _inverses = np.cumprod(grown), np.cumprod(back)
    return _powers, _inverses


@cache
def _separator(text: bool) -> np.ndarray:
    table = np.zeros(256, bool)
    if text:  # everything in ASCII but letters and digits
        table[:128] = True
        for first, last in ((48, 57), (65, 90), (97, 122)):
            table[first : last + 1] = False
    else:
        table[list(SPACES)] = True
    return table


@cache
def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _lowered()[data]


def word_bounds(data: np.ndarray, terms: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: runs without white space, or with ``terms`` runs of letters and digits."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_separator(terms)[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; equal words have equal hashes anywhere."""
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(byte_values()[data] * power[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U) * ODD)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    out = np.zeros(n, _U)
    for k in range(size):
        out = mixed(out * _U(0xA0761D6478BD642F) + words[k : k + n] + _U(k + 1))
    return out


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)
