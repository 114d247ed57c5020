"""Vectorised hashes of the words of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes that part words: ASCII white space.
SPACES = bytes([9, 10, 11, 12, 13, 32])

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def byte_values(seed: int, classes: bytes | None = None) -> np.ndarray:
    """A random number for each byte; bytes of the same class have the same one. Class 0 counts nothing."""
    values = np.random.default_rng(seed).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    if classes is None:
        return values
    values[0] = 0
    return values[np.frombuffer(classes, np.uint8)]


class _Powers:
    up, down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            make = lambda base: np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64)
            cls.up, cls.down = make(_BASE), make(_BACK)
        return cls.up, cls.down


def mixed(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def segment_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of values[begin:end] for each segment, the same wherever it lies."""
    up, down = _Powers.to(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mixed((total[end] - total[begin]) * down[begin])


class Words:
    """The words of some texts: their bytes, where each word begins and ends, and how many words each text has."""

    def __init__(self, texts: list[bytes]):
        self.flat = np.frombuffer(b"".join([b"\n", *(x for t in texts for x in (t, b"\n"))]), np.uint8)
        space = _IS_SPACE[self.flat]
        self.begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        self.end = np.flatnonzero(~space[:-1] & space[1:]) + 1
        last = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        upto = np.searchsorted(self.begin, last, "right")
        self.count = np.diff(np.r_[0, upto])

    def hashes(self, values: np.ndarray) -> np.ndarray:
        """A hash of each word, from the numbers of its bytes."""
        return segment_hashes(values[self.flat], self.begin, self.end)

    def shapes(self, classes: np.ndarray, values: np.ndarray) -> np.ndarray:
        """A hash of each word's shape: the classes of its bytes, runs counted once."""
        kind = classes[self.flat]
        fresh = np.r_[True, kind[1:] != kind[:-1]]
        fresh[self.begin] = True
        at = np.flatnonzero(fresh)
        return segment_hashes(values[kind[at]], np.searchsorted(at, self.begin), np.searchsorted(at, self.end))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def slices(texts: list[bytes], size: int = 1_000_000) -> Iterator[list[bytes]]:
    """Texts in order, about `size` bytes at a time."""
    part, total = [], 0
    for text in texts:
        if part and total + len(text) > size:
            yield part
            part, total = [], 0
        part.append(text)
        total += len(text)
    if part:
        yield part
