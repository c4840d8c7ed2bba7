"""Content-defined anchors: positions that every copy of a long string selects alike."""

from __future__ import annotations

import numpy as np

from .shingles import _VALUES, mixed, powers


class Grams:
    """Hashes of any substrings of a byte string."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_VALUES[raw] * up[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))

    def all(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:n]) * self.down[:n])


def _sliding(x: np.ndarray, w: int, ufunc) -> np.ndarray:
    """ufunc over each window of w values, from accumulations within blocks of w from both sides."""
    n = len(x)
    size = -(-n // w) * w
    pad = np.full(size, x[-1], x.dtype)
    pad[:n] = x
    blocks = pad.reshape(-1, w)
    left = ufunc.accumulate(blocks, axis=1).ravel()
    right = ufunc.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(right[: n - w + 1], left[w - 1 : n])


def anchors(grams: Grams, n: int, k: int, length: int) -> np.ndarray:
    """Starts of k-grams that are least in some window, as long as ``length``, of a text of n bytes: each string of that length
    holds one, and each of its copies the same. Equal least k-grams of a window are all anchors."""
    w = length - k + 1
    if n < length:
        return np.zeros(0, np.int64)
    h = grams.all(k)
    low = _sliding(h, w, np.minimum)
    ends = np.full(w - 1, 0, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate((ends, low, ends)), w, np.maximum) == h)
