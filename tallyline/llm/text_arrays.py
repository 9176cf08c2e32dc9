"""Whole texts as byte arrays: word bounds and 64-bit hashes for many texts at once.

The operators of this package cut texts at ASCII white space. Here that is done with numpy over
the bytes of an Arrow batch, so that the cost of a text does not include a Python object for each
of its words. Two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 20
# Fixed odd numbers that keep positions and lengths apart.
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the bounds of its texts; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def groups(bounds: np.ndarray, most: int = 4 << 20):
    """(first, last) rows of runs of texts with about `most` bytes; a longer text is a run alone."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1)
        yield first, last
        first = last


def word_bounds(
    data: np.ndarray, bounds: np.ndarray, blank: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of each word of all texts, and the words each text begins at (one entry more).

    Words are the maximal runs of bytes that are not `blank`.
    """
    solid = np.concatenate([[False], ~blank[data], [False]])
    starts = solid[1:] & ~solid[:-1]
    ends = solid[:-1] & ~solid[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    cut = inner[solid[inner] & solid[inner + 1]]
    starts[cut] = True
    ends[cut] = True
    start = np.flatnonzero(starts[:-1])
    return start, np.flatnonzero(ends), np.searchsorted(start, bounds)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges ascend and do not overlap.

    A range is read in lanes of eight bytes. Each lane is mixed with its place before the lanes are
    added up, so that no arrangement of equal lanes cancels out.
    """
    out = np.zeros(len(start), np.uint64)
    first = 0
    while first < len(start):
        base = int(start[first])
        last = int(np.searchsorted(end, base + WINDOW, "right"))
        if last <= first:  # longer than a window
            out[first] = int.from_bytes(hashlib.blake2b(data[base : end[first]], digest_size=8).digest(), "little")
            first += 1
            continue
        out[first:last] = _lane_hashes(data[base : end[last - 1]], start[first:last] - base, end[first:last] - base)
        first = last
    return out


def _lane_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ranges of one window."""
    value, begin, place = _lanes(data, start, end)
    value = mixed(value + (place + 1).astype(np.uint64) * _PLACE)
    return mixed(np.add.reduceat(value, begin) + (end - start).astype(np.uint64) * _LENGTH)


def _lanes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ranges, eight to a number; the lane each range begins at; each lane's place in its range."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    lanes = np.maximum(1, (end - start + 7) >> 3)
    begin = np.cumsum(lanes) - lanes
    place = np.arange(int(lanes.sum())) - np.repeat(begin, lanes)
    at = np.repeat(start, lanes) + 8 * place
    rest = np.minimum(np.repeat(end, lanes) - at, 8)
    kept = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 9))], np.uint64)
    return eight[at] & kept[rest], begin, place


def equal_ranges(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, first: np.ndarray, size: np.ndarray
) -> np.ndarray:
    """Whether each byte range start..end of `data` holds the `size` bytes of `other` from `first` on."""
    same = end - start == size
    at = np.flatnonzero(same)
    for k in range(0, len(at), WINDOW >> 4):
        own = at[k : k + (WINDOW >> 4)]
        mine, begin, _ = _lanes(data, start[own], end[own])
        theirs, _, _ = _lanes(other, first[own], first[own] + size[own])
        same[own] = np.logical_and.reduceat(mine == theirs, begin)
    return same
