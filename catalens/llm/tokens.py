"""Words of UTF-8 columns as Arrow dictionaries, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32  # A-Z alone; other letters stay

WORD, GAP, BREAK = 0, 1, 2


def kinds(gap: bytes = b"", brk: bytes = b"", word: bytes | None = None) -> np.ndarray:
    """Table of byte kinds. ``word``: the ASCII word bytes (all others are gaps); else ``gap`` and ``brk`` are listed."""
    table = np.zeros(256, dtype=np.uint8)
    if word is not None:
        table[:128] = GAP
        table[list(word)] = WORD
    table[list(gap)] = GAP
    table[list(brk)] = BREAK
    return table


def slices(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``max_bytes`` of text, at least one row each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo, n = 0, len(texts)
    while lo < n:
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + max_bytes, "right"))
        hi = max(hi, lo + 1)
        yield lo, hi
        lo = hi


def words(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(word ids, the distinct words, row of each word, piece of each word) of a string array; null texts are empty.

    Words are maximal runs of word bytes inside a row, A-Z lower-cased. Words of one row with no BREAK byte between
    them share a piece.
    """
    whole = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    if lo == hi:
        return np.empty(0, np.int32), pa.array([], pa.large_binary()), np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(whole.buffers()[2], dtype=np.uint8)[lo:hi]
    row_start = offsets[:-1] - lo
    kind = table[data]
    inside = kind == WORD
    own = row_start[row_start < hi - lo]  # first byte of every row that has one
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[own] = inside[own]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[own[own > 0] - 1] = inside[own[own > 0] - 1]
    starts = np.flatnonzero(first)
    bounds = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(np.flatnonzero(last) + 1 - starts, out=bounds[1:])
    spelt = _LOWER[data[inside]]
    made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(spelt)])
    coded = made.dictionary_encode()
    row = np.searchsorted(row_start, starts, "right") - 1
    piece = np.cumsum(kind == BREAK, dtype=np.int32)[starts] + row
    return coded.indices.to_numpy(), coded.dictionary, row, piece
