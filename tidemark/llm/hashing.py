"""Hashes of many substrings at once: prefix sums over the bytes of a batch of texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)


def spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers for a seed."""
    return spread((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(BASE))


LETTERS = numbers(256, 1)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i < n, kept for the next batch."""
    if not _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            row = np.full(n, base, np.uint64)
            row[:1] = 1
            _POWERS[name] = np.cumprod(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Substrings:
    """Hashes of any substrings of one buffer; equal strings have equal hashes."""

    def __init__(self, data: bytes | np.ndarray):
        self.bytes = np.frombuffer(data, np.uint8) if isinstance(data, (bytes, bytearray)) else data
        n = len(self.bytes)
        up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(LETTERS[self.bytes] * up[:n], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def windows(self, size: int) -> np.ndarray:
        """The hash of the substring of ``size`` bytes at each place that has one."""
        n = max(0, len(self.bytes) - size + 1)
        return (self.sums[size : size + n] - self.sums[:n]) * self.down[:n]


def buffers(texts: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """Consecutive texts in lists of about ``size`` bytes, each text whole."""
    held: list[bytes] = []
    total = 0
    for text in texts:
        held.append(text)
        total += len(text)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held
