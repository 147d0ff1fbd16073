"""Words and word sequences of whole texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

A, B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))

#: Bytes that are hashed together.
CHUNK = 1 << 17

#: Bytes of a word, in UTF-8; bytes of other than ASCII characters belong to words in both.
NOT_SPACE = np.array([b not in (0x20, *range(0x09, 0x0E)) for b in range(256)])
ALPHANUMERIC = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * A
    x = x ^ (x >> np.uint64(33))
    x = x * B
    return x ^ (x >> np.uint64(33))


CODES = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP to the i-th power and its inverse, for i up to ``n``."""
    if len(_powers[0]) < n:
        size = max(n, 2 * CHUNK)
        for k, base in enumerate((STEP, BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


class Words:
    """All words of the texts in ``data`` (each from ``offsets[i]`` to ``offsets[i + 1]``).

    ``doc``: text of each word; ``start``, ``end``: its bytes; ``hash``: of the
    word with A-Z lowered; ``first``: word number at which each text begins.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        n = len(data)
        self.low = LOWER[data]
        member = inside[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = member[:-1], member[1:]
        self.start = np.flatnonzero(member & (~before | edge[:n]))
        self.end = np.flatnonzero(member & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash, i = np.empty(len(self.start), np.uint64), 0
        while i < len(self.start):  # some words at a time
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + CHUNK, "right")))
            a, b = self.start[i], self.end[j - 1]
            up, down = powers(b - a + 1)
            total = np.zeros(b - a + 1, np.uint64)
            np.cumsum(CODES[self.low[a:b]] * up[: b - a], out=total[1:])
            s, e = self.start[i:j] - a, self.end[i:j] - a
            self.hash[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            i = j

    def bytes_of(self, first: int, count: int) -> bytes:
        """The lowered words from number ``first``, joined by a space."""
        return b" ".join(self.low[s:e].tobytes() for s, e in zip(self.start[first : first + count], self.end[first : first + count]))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive entries (across texts as well)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    if n <= 4:
        total = np.zeros(count, np.uint64)
        for k in range(n):
            total = total * STEP + hashes[k : k + count]
        return mix(total + np.uint64(n))
    up, down = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[:count] + np.uint64(n))
