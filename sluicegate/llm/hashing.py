"""Hashes of words and of integers, a slice of texts at a time."""

from __future__ import annotations

import numpy as np

_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A good hash of 64-bit integers."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_inverse = pow(int(BASE), -1, 1 << 64)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_hashes(texts: list[str | None], fold: np.ndarray = _FOLD) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word, in order; ``fold`` gives for each byte what it counts as, 32 between words."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    data = fold[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    inside = data != 32
    edges = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    size = 1 << max(16, int(len(data)).bit_length())
    if size not in _tables:
        _tables.clear()
        _tables[size] = (_powers(int(BASE), size), _powers(_inverse, size))
    powers, inverses = _tables[size]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], dtype=np.uint64)))
    word = mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
    return word, np.searchsorted(begins, starts, side="right") - 1
