"""Words of many texts at once, as 64-bit hashes computed on the UTF-8 bytes.

A word is a maximal run of bytes other than ``[\\x20\\x09-\\x0D]``; those are
single bytes in UTF-8, so splitting bytes equals splitting code points. The
hash of a span is a polynomial over random per-byte values modulo 2**64, taken
from prefix sums, so that the cost per byte is a few vector operations and does
not depend on the number of words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
IS_WS = np.zeros(256, dtype=bool)
IS_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@lru_cache(maxsize=2)
def _bytes_table(fold: bool) -> np.ndarray:
    t = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    if fold:
        t = t.copy()
        t[65:91] = t[97:123]
    return t


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(m: int) -> np.ndarray:
        a = np.full(n, m, dtype=np.uint64)
        a[0] = 1
        return np.cumprod(a)

    return run(_MULT), run(_INV)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    return _powers(size)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit hash (finaliser of splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Bytes:
    """The bytes of the texts of one Arrow column slice and hashes of their spans (null text: empty).

    ``data``: the bytes, each text followed by one newline; ``start``: where each
    text begins in them (one more entry at the end); ``n``: number of texts.
    """

    def __init__(self, column: pa.Array, fold: bool = False) -> None:
        texts = pc.fill_null(column.cast(pa.large_binary()), b"")
        joined = pc.binary_join_element_wise(texts, pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
        self.n = len(joined)
        if self.n == 0:
            self.data = np.zeros(0, np.uint8)
            self.start = np.zeros(1, np.int64)
        else:
            offs = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + self.n + 1]
            self.data = np.frombuffer(joined.buffers()[2], np.uint8)[offs[0]:offs[-1]]
            self.start = offs - offs[0]
        n = len(self.data)
        up, self._down = powers(n + 1)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(_bytes_table(fold)[self.data] * up[:n], out=self._sum[1:])

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span; equal bytes give equal hashes at any place."""
        return mix((self._sum[end] - self._sum[begin]) * self._down[begin] + (end - begin).astype(np.uint64))

    def per_text(self, flag: np.ndarray) -> np.ndarray:
        """Number of flagged bytes in each text."""
        total = np.zeros(len(flag) + 1, np.int64)
        np.cumsum(flag, out=total[1:])
        return total[self.start[1:]] - total[self.start[:-1]]


class Words(Bytes):
    """Word hashes besides. ``hash``: of each word; ``first``: index of each text's
    first word (one more entry at the end); ``doc``: the text that a word belongs to.
    """

    def __init__(self, column: pa.Array, fold: bool = False) -> None:
        super().__init__(column, fold)
        self.ws = IS_WS[self.data]
        word = np.zeros(len(self.data) + 2, np.int8)
        word[1:-1] = ~self.ws
        step = np.diff(word)
        self.begin, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.hash = self.spans(self.begin, self.end)
        self.first = np.searchsorted(self.begin, self.start)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.count)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the first word) of every window of ``n`` words inside one text."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = np.zeros(m, np.uint64)
        for k in range(n):
            h = h * np.uint64(0xD6E8FEB86659FD93) + self.hash[k:k + m]
        at = np.flatnonzero(self.doc[:m] == self.doc[n - 1:n - 1 + m])
        return mix(h[at]), at


def keyed(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One 64-bit key for (text, hash)."""
    return mix(h ^ mix(doc.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)))
