"""Sampled suffixes of byte texts: the anchors that a sparse suffix array is built on.

Of the ``SAMPLED`` grams that start in a 100-byte string, the one with the least hash (the leftmost
of equals) is its anchor.  The choice depends on the string alone, so equal strings
have equal anchors at equal offsets; an anchor owns the run of strings that chose it,
and its span is the bytes of that run.
"""

from __future__ import annotations

import numpy as np

from .textarrays import mix64, prefix_hash, span_hash

#: Bytes of a gram.
GRAM = 32
#: Bits of an anchor's place inside its document while minima are taken.
PLACE_BITS = 28


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Anchors of a chunk of rows: row, at (byte in the row), first and last string start, gram, span hash."""
    none = np.zeros(0, np.int64)
    n, sampled = len(data), length - GRAM + 1
    if n < length:
        return {k: none for k in ("row", "at", "lo", "hi")} | {"gram": none.astype(np.uint64), "span": none.astype(np.uint64)}
    prefix = prefix_hash(data)
    starts = np.arange(n - GRAM + 1)
    grams = span_hash(prefix, starts, starts + GRAM)
    sizes = np.diff(offsets)
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(n) - offsets[:-1][row_of]
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (grams & ~low) | place[:len(grams)].astype(np.uint64)
    # minima over `sampled` neighbours by doubling
    least, span = key, 1
    while span * 2 <= sampled:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = sampled - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    whole = np.flatnonzero(place[:len(least)] + length <= sizes[row_of[:len(least)]])
    row, at = row_of[whole], (least[whole] & low).astype(np.int64)
    if not len(whole):
        return {k: none for k in ("row", "at", "lo", "hi")} | {"gram": none.astype(np.uint64), "span": none.astype(np.uint64)}
    new = np.ones(len(whole), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(whole)) - 1
    row, at = row[begin], at[begin]
    lo, hi = place[whole[begin]], place[whole[end]]
    base = offsets[:-1][row]
    gram = grams[base + at]
    spans = span_hash(prefix, base + lo, base + hi + length)
    return {"row": row, "at": at, "lo": lo, "hi": hi, "gram": gram,
            "span": mix64(spans + (at - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + gram)}
