"""Terms of many texts at once: maximal runs of digits, letters a-z and code points from U+0080, A-Z lower-cased.

Those are the matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z
folded. The excluded characters are single bytes in UTF-8, so splitting bytes
equals splitting code points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .wordhash import Bytes

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IN_TERM = np.zeros(256, dtype=bool)
IN_TERM[48:58] = IN_TERM[65:91] = IN_TERM[97:123] = IN_TERM[128:] = True

TERM_SQL = r"[0-9a-z\x{80}-\x{10FFFF}]+"


class Terms(Bytes):
    """``begin``, ``end``: span of each term in ``data``; ``doc``: its text; ``first``: index of each text's first term (one more at the end)."""

    def __init__(self, column: pa.Array) -> None:
        super().__init__(column, fold=True)
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = IN_TERM[self.data]
        step = np.diff(inside)
        self.begin, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.first = np.searchsorted(self.begin, self.start)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.count)

    def hashes(self) -> np.ndarray:
        return self.spans(self.begin, self.end)


def count_terms(column: pa.Array) -> np.ndarray:
    """Number of terms of each text, without hashing."""
    size = len(column)
    if size == 0:
        return np.zeros(0, np.int64)
    texts = column.cast(pa.large_binary()).fill_null(b"")
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + size + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offs[0]:offs[-1]]
    offs = offs - offs[0]
    inside = IN_TERM[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    at = offs[:-1][offs[:-1] < offs[1:]]
    starts[at] = inside[at]  # a term ends with its text
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(starts, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]
