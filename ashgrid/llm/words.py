"""Words of a batch of texts as numpy arrays, straight from Arrow buffers.

A word is a maximal run of letters and digits after Unicode lower-casing.  In
ASCII those are ``a-z0-9``; every other code point belongs to a word, except
those of the Latin-1 signs, general punctuation and CJK punctuation blocks,
which separate words like a space does.  No Python string is made: positions
come from byte masks and hashes from prefix sums of a polynomial modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 19

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_C = np.uint64(0xD6E8FEB86659FD93)
_WORD = np.zeros(256, dtype=bool)
_WORD[ord("0"):ord("9") + 1] = _WORD[ord("a"):ord("z") + 1] = _WORD[128:] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept up to the chunk size."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    made = []
    for base in (_P, _P_INVERSE):
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        made.append(np.multiply.accumulate(factors))
    if n <= 2 * CHUNK_BYTES:
        _powers = (made[0], made[1])
    return made[0], made[1]


@dataclass
class Words:
    """Words of the texts ``lo .. hi-1`` of a batch."""

    lo: int
    hi: int
    data: np.ndarray       # lower-cased UTF-8 bytes of the chunk
    start: np.ndarray      # first byte of each word in ``data``
    end: np.ndarray        # byte after each word
    first: np.ndarray      # index of each text's first word, and one more
    hash: np.ndarray       # 64-bit hash of each word

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words, and where each text's begin.

        A text of fewer than ``n`` words, but at least one, has one run of
        all its words; a text without words has none.
        """
        h, count = self.hash, np.diff(self.first)
        if not len(h):
            return np.zeros(0, np.uint64), np.zeros(len(count) + 1, np.int64)
        rolled = h.copy()
        for k in range(1, n):
            rolled[:-k] = rolled[:-k] * _C + h[k:] if k < len(h) else rolled[:0]
        per_text = np.where(count >= n, count - n + 1, np.minimum(count, 1))
        offsets = np.concatenate(([0], np.cumsum(per_text)))
        index = np.arange(offsets[-1]) + np.repeat(self.first[:-1] - offsets[:-1], per_text)
        out = rolled[index]
        for t in np.flatnonzero((count > 0) & (count < n)):
            value = np.uint64(0)
            with np.errstate(over="ignore"):
                for w in h[self.first[t]:self.first[t + 1]]:
                    value = value * _C + w
            out[offsets[t]] = value
        return mix(out), offsets


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a large_string array without nulls."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    return offsets, np.frombuffer(data, np.uint8)


def _word_mask(data: np.ndarray) -> np.ndarray:
    mask = _WORD[data]
    for lead, follow in ((0xC2, None), (0xE2, (0x80, 0x81)), (0xE3, (0x80, 0x80))):
        at = np.flatnonzero(data == lead)
        if not len(at):
            continue
        if follow is None:
            at = at[~np.isin(data[at + 1], (0xAA, 0xB5, 0xBA))]
            mask[at] = mask[at + 1] = False
        else:
            at = at[(data[at + 1] >= follow[0]) & (data[at + 1] <= follow[1])]
            mask[at] = mask[at + 1] = mask[at + 2] = False
    return mask


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of all texts of a batch, a bounded number of bytes at a time.

    Nulls are empty texts.  Only the chunk at work is lower-cased and copied.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(texts):
        return
    place, _ = utf8(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(place, place[lo] + size, "right")) - 1)
        offsets, data = utf8(pc.utf8_lower(texts[lo:hi]))
        yield words_of(data[offsets[0]:offsets[-1]], offsets - offsets[0], lo, hi)
        lo = hi


def words_of(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> Words:
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(lo, hi, data, none, none, np.zeros(hi - lo + 1, np.int64),
                     np.zeros(0, np.uint64))
    mask = _word_mask(data)
    starts = mask.copy()
    starts[1:] &= ~mask[:-1]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < n)]
    starts[borders] = mask[borders]           # a word never runs over two texts
    ends = mask.copy()
    ends[:-1] &= ~mask[1:] | starts[1:]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets, "left")
    return Words(lo, hi, data, start, end, first, hashes(data, start, end))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:end]``."""
    n = len(data)
    power, inverse = _power_tables(n + 1)
    prefix = np.empty(n + 1, np.uint64)
    prefix[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inverse[start])
