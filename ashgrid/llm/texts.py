"""Batches of texts as Python strings, a bounded number of bytes at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts of ASCII and Latin letters only.  For them the standard library's
#: pattern classes agree with Unicode's letters, digits and spaces (Latin-1's
#: fractions and small raised digits, which don't, are left out).
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*")
#: The letters of plain texts, for use inside a character class.
LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"


def slices(column: pa.Array, size: int = 4 << 20) -> Iterator[tuple[int, int, list[str]]]:
    """(lo, hi, texts) runs of a text column of about ``size`` bytes; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(column):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + size, "right")))
        yield lo, hi, column[lo:hi].to_pylist()
        lo = hi
