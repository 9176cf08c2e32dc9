"""Canonical length-limited Huffman codes over token ids, with numpy.

A code is its list of lengths: codes of equal length follow the order of the ids, so the lengths
alone restore the code. Token streams are cut into blocks whose bit offsets are kept, so that all
blocks of a segment decode side by side, each step one lookup in a table of 2**limit entries.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512


def code_lengths(counts: np.ndarray, limit: int = 16) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits (package-merge); 0 for ids that never occur.

    One occurring id alone gets length 1. Needs 2**limit >= number of occurring ids, and a limit of
    at most 24.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if not 1 <= limit <= 24 or len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    n = len(order)
    levels = []
    packages = np.zeros(0, np.int64)
    for _ in range(limit):
        merged = np.concatenate([weight, packages])
        place = np.argsort(merged, kind="stable")
        levels.append(place < n)
        merged = merged[place]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * (n - 1)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())  # leaves are taken in ascending order of weight
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id as an integer of `lengths` bits."""
    codes = np.zeros(len(lengths), np.uint32)
    code = 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        ids = np.flatnonzero(lengths == bits)
        codes[ids] = code + np.arange(len(ids))
        code = (code + len(ids)) << 1
    return codes


def decode_table(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each value of the next `limit` bits, the id that begins there and its length."""
    ids = np.zeros(1 << limit, np.uint32)
    bits = np.zeros(1 << limit, np.uint8)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]  # canonical codes ascend in this order
    span = (1 << (limit - lengths[order].astype(np.int64))).astype(np.int64)
    total = int(span.sum())
    ids[:total] = np.repeat(order, span)
    bits[:total] = np.repeat(lengths[order], span)
    return ids, bits


def encode(ids: np.ndarray, cuts: np.ndarray, codes: np.ndarray, lengths: np.ndarray):
    """Bits of `ids` and the bit offset at each position of `cuts`."""
    bits = lengths[ids].astype(np.int64)
    at = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(bits, out=at[1:])
    payload = np.zeros((int(at[-1]) + 7) // 8 + 4, np.int64)
    # Each code touches at most four bytes; codes share no bit, so sums are unions.
    wide = codes[ids].astype(np.uint64) << (32 - bits - (at[:-1] & 7)).astype(np.uint64)
    where = at[:-1] >> 3
    for k in range(4):
        part = ((wide >> np.uint64(24 - 8 * k)) & np.uint64(255)).astype(np.float64)
        payload += np.bincount(where + k, part, len(payload)).astype(np.int64)
    return payload[: (int(at[-1]) + 7) // 8].astype(np.uint8), at[cuts]


def decode(payload: np.ndarray, offsets: np.ndarray, counts: np.ndarray, table, limit: int) -> np.ndarray:
    """The ids of all blocks in turn; a block has `counts` ids from bit `offsets` on."""
    ids, bits = table
    padded = np.concatenate([payload, np.zeros(8, np.uint8)]).astype(np.uint32)
    words = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint32)
    order = np.argsort(-counts, kind="stable")  # the blocks still open are a prefix of this order
    at, place, left = offsets[order].astype(np.int64), first[order], counts[order]
    shift = np.uint32(32 - limit)
    for step in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -step, "left"))
        at, place = at[:live], place[:live]
        key = (words[at >> 3] << (at & 7).astype(np.uint32)) >> shift
        out[place + step] = ids[key]
        at = at + bits[key]
    return out
