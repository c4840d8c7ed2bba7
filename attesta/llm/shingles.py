"""Sets of word shingles as sorted 64-bit hashes, hashed array-wise."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text that are hashed at a time (one text at least).
CHUNK = 1 << 20
_rng = np.random.default_rng(8675309)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x5851F42D4C957F2D
_MIX = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + (CHUNK >> 2))
        _powers[:] = [np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size - 1, np.uint64(b))))) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a buffer."""
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([True], blank, [True])).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * up[: len(raw)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > CHUNK:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text) + 1
    if part:
        yield part


def shingle_sets(texts: list[bytes], k: int = 5) -> Iterator[np.ndarray]:
    """For each text its set of k-word shingles, sorted; a text of fewer words has its word sequence as one."""
    for part in chunks(texts):
        raw = np.frombuffer(b" ".join(part).lower(), np.uint8)
        at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in part])))
        starts, words = _words(raw)
        bounds = np.searchsorted(starts, at)
        n = max(0, len(words) - k + 1)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = mixed(h * np.uint64(31) + words[j : j + n])
        for a, b in zip(bounds, bounds[1:], strict=False):
            if b - a >= k:
                yield np.unique(h[a : b - k + 1])
            elif b > a:
                one = np.array([b - a], np.uint64)
                for w in words[a:b]:
                    one = mixed(one * np.uint64(31) + w)
                yield one
            else:
                yield np.zeros(0, np.uint64)
