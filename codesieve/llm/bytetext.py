"""Words of many texts at once, as arrays over the UTF-8 bytes of an Arrow batch.

Everything here works on slices of whole documents of about a megabyte, so that memory follows the longest
document and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_R = np.uint64(0x165667B19E3779F9)

#: Bytes 0x20 and 0x09 to 0x0D are spaces.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; one to one."""
    x = x ^ (x >> np.uint64(31))
    x = x * _Q
    x = x ^ (x >> np.uint64(29))
    x = x * _P
    return x ^ (x >> np.uint64(32))


@dataclass
class Slice:
    """Consecutive documents ``first ..`` of a batch: their bytes, and where each begins and ends in them."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of an Arrow column, nulls as empty ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.binary() if column.type == pa.string() else column.type).cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        base = offsets[first]
        yield Slice(first, data[base : offsets[last]], offsets[first:last] - base, offsets[first + 1 : last + 1] - base)
        first = last


def word_bounds(part: Slice, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of word bytes (a flag per byte); a run ends with its document."""
    begin, stop = is_word.copy(), is_word.copy()
    if len(is_word):
        inner = part.starts[(part.starts > 0) & (part.starts < len(is_word))]
        cut = np.zeros(len(is_word), bool)
        cut[inner] = True
        begin[1:] &= ~is_word[:-1] | cut[1:]
        stop[:-1] &= ~is_word[1:] | cut[1:]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def word_hashes(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    hashes = np.zeros(len(begin), np.uint64)
    left = np.arange(len(begin))
    at, end = begin.copy(), stop
    while len(left):
        hashes[left] = hashes[left] * _R + data[at].astype(np.uint64) + np.uint64(1)
        at = at + 1
        more = at < end
        left, at, end = left[more], at[more], end[more]
    return mix(hashes + (stop - begin).astype(np.uint64))


def window_hashes(hashes: np.ndarray, span: int) -> np.ndarray:
    """A hash of every ``span`` consecutive word hashes, at the place of the first."""
    total = np.zeros(max(0, len(hashes) - span + 1), np.uint64)
    for k in range(span):
        total = total * _R + mix(hashes[k : k + len(total)] + np.uint64(k))
    return mix(total)


def to_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
