"""Vectorised text features: whole batches of texts become arrays of code points, n-gram hashes and word hashes."""

from __future__ import annotations

import unicodedata

import numpy as np

_SPACE = 32


def letter_table(size: int = 65536) -> np.ndarray:
    """For each code point of the basic plane its lower-case letter, or a space if it is none."""
    out = np.full(size, _SPACE, np.uint32)
    for c in range(size):
        if unicodedata.category(chr(c))[0] == "L":
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts, each text after a space, and the places where the texts begin.

    Null and empty texts give the space alone, so that every text owns at least one place.
    """
    texts = [x or "" for x in texts]
    joined = " " + " ".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
    return points, np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)


_M = np.uint32(2654435761)


def char_ngrams(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """For each place the hash of the n code points from there; n-grams past the end wrap to zeros."""
    padded = np.concatenate([points, np.zeros(n - 1, np.uint32)]) if n > 1 else points
    size = len(points)
    h = padded[:size] * _M + np.uint32(n)
    for i in range(1, n):
        h ^= h >> np.uint32(15)
        h += padded[i : i + size]
        h *= _M
    h ^= h >> np.uint32(13)
    return (h >> np.uint32(32 - bits)).astype(np.int32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values (public-domain constants of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_P = 0x100000001B3
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n of a fixed odd number modulo 2^64, and of its inverse; kept for the next call."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        for i, x in enumerate((_P, pow(_P, -1, 1 << 64))):
            grown = np.full(size, x, np.uint64)
            grown[0] = 1
            _powers[i] = np.multiply.accumulate(grown)
    return _powers[0], _powers[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts whose words stand single-spaced, and each text's word count.

    A word's hash is a polynomial over its bytes, mixed. Equal words give equal hashes wherever they stand.
    """
    counts = np.fromiter((x.count(" ") + 1 if x else 0 for x in texts), np.int64, len(texts))
    joined = " ".join(x for x in texts if x).encode("utf-8", "surrogatepass")
    if not joined:
        return np.zeros(0, np.uint64), counts
    raw = np.frombuffer(joined, np.uint8)
    up, down = powers(len(raw))
    ends = np.flatnonzero(raw == 32)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(raw * up[: len(raw)], dtype=np.uint64, out=sums[1:])
    starts = np.concatenate([[0], ends + 1])
    ends = np.concatenate([ends, [len(raw)]])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _B), counts


def single_spaced(text: str | None) -> str:
    """Lower case, words with one space between."""
    return " ".join((text or "").lower().split())


def word_shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words of one text; of the whole text where it has fewer words; none if empty."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h = (h ^ words[i : n - k + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return mix64(h)
