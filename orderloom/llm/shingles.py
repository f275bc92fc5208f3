"""Sets of hashed word shingles, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from orderloom.llm.common import chunks

_RATIO = 0x9E3779B97F4A7C15 | 1
_WORD = 0xD6E8FEB86659FD93
# Fixed values of the contract: code points that separate words.
_SPACES = [0x20, *range(0x09, 0x0E)]


@lru_cache(1)
def _is_space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[_SPACES] = True
    return table


@lru_cache(1)
def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash's ratio modulo 2^64, or of its inverse."""
    key = "inverse" if inverse else "direct"
    have = _powers.get(key)
    if have is None or len(have) < n:
        ratio = pow(_RATIO, -1, 1 << 64) if inverse else _RATIO
        have = np.full(max(n, 1 << 21), ratio, np.uint64)
        have[0] = 1
        have = np.cumprod(have)
        _powers[key] = have if n <= 1 << 23 else have[: 1 << 21].copy()
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in `raw` (bytes), and where they start."""
    inside = ~_is_space()[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_lower()[raw].astype(np.uint64) + np.uint64(1)) * powers(len(raw)), out=total[1:])
    value = (total[end] - total[start]) * powers(len(raw) + 1, inverse=True)[start]
    return mix(value + (end - start).astype(np.uint64) * np.uint64(_WORD)), start


def sets(texts: list[str], width: int = 5) -> Iterator[np.ndarray]:
    """For each text its sorted, distinct shingles of `width` words as 64-bit hashes.

    A text of fewer words has its whole sequence as one shingle, a text without words none.
    """
    for first, last in chunks(texts):
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts[first:last]]
        raw = np.frombuffer(b" ".join(encoded), np.uint8)
        ends = np.cumsum([len(e) + 1 for e in encoded])
        words, start = _words(raw)
        bounds = np.searchsorted(start, np.concatenate([[0], ends]))
        n = max(0, len(words) - width + 1)
        grams = np.zeros(n, np.uint64)
        for i in range(width):
            grams += words[i : i + n] * np.uint64((_WORD * (2 * i + 3)) & (2**64 - 1) | 1)
        grams = mix(grams)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= width:
                found = np.sort(grams[a : b - width + 1])
                yield found[np.concatenate([[True], found[1:] != found[:-1]])]
            elif b > a:
                value = np.uint64(b - a)
                for i in range(a, b):
                    value = mix(np.array([value ^ words[i]]) * np.uint64(_WORD))[0]
                yield np.array([value], np.uint64)
            else:
                yield np.zeros(0, np.uint64)
