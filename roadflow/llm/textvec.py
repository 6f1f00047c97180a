"""Vectorised words and hashes of a block of texts (numpy inside a task)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_MULT, _INV = U(0x9E3779B97F4A7C15), U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Separators of `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Everything of ASCII but letters; bytes of other scripts count as letters.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads 64-bit keys."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_powers = [np.ones(1, U), np.ones(1, U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse; a worker keeps those of usual blocks (16 MB), not longer ones."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    made = []
    for base in (_MULT, _INV):
        p = np.full(max(n, 1 << 20), base, U)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if n <= 1 << 20:
        _powers[:] = made
    return made[0][:n], made[1][:n]


def blocks(texts: list[str | None], most: int = 500_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` characters; a longer text is a range of its own."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


class Block:
    """Texts joined by line feeds, A-Z lowered if asked; hashes of any byte ranges."""

    def __init__(self, texts: list[str | None], lower: bool = True):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.n = len(raw)
        sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, self.n)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        self._sums = None

    def words(self, delimiters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and the row that it belongs to."""
        gap = delimiters[self.buf]
        gap[self.starts[1:] - 1] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).view(np.int8)))
        s, e = edge[0::2], edge[1::2]
        return s, e, np.searchsorted(self.starts, s, side="right") - 1

    def hashes(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes in [s, e): equal bytes have equal hashes wherever they stand."""
        p, inv = _power(len(self.buf) + 1)
        if self._sums is None:
            sums = np.zeros(len(self.buf) + 1, U)
            np.cumsum(_BYTE[self.buf] * p[:-1], out=sums[1:])
            self._sums = sums
        return mix((self._sums[e] - self._sums[s]) * inv[s] + (e - s).astype(U))
