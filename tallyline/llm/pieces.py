"""Ids of the pieces of many texts, each distinct piece encoded once while it is remembered."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

# Pieces looked up at a time, and bytes that the remembered ones of a worker may take.
CHUNK = 1 << 15
MOST_BYTES = 96 << 20
# Bytes that a remembered piece takes besides its own and four for each id, and the longest one that is remembered.
_OVERHEAD, _LONGEST = 170, 512


class Pieces:
    """Ids by byte string. `encode` gives the ids of strings as 4-byte integers; about `most` bytes are kept.

    Strings are compared whole, so equal ids never rest on equal hashes. What is kept comes in two
    generations: when the young one has its half, it replaces the old one, from which strings that
    are met again come back. Frequent strings stay.
    """

    def __init__(self, encode: Callable[[list[bytes]], Sequence[bytes]], most: int = MOST_BYTES):
        self.encode = encode
        self.most = most // 2
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all byte ranges in turn, and the ids before each range and after the last."""
        found = [self._some(data, start[k : k + CHUNK], end[k : k + CHUNK]) for k in range(0, len(start), CHUNK)]
        upto = np.zeros(len(start) + 1, np.int64)
        if found:
            np.cumsum(np.concatenate([count for _, count in found]), out=upto[1:])
        return np.concatenate([np.zeros(0, np.int32), *(ids for ids, _ in found)]), upto

    def _some(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = int(start[0])
        raw = data[base : end[-1]].tobytes()
        pieces = [raw[a:b] for a, b in zip((start - base).tolist(), (end - base).tolist(), strict=True)]
        if self.held > self.most:
            self.young, self.old, self.held = {}, self.young, 0
        known, old = self.young, self.old
        missing = []
        for piece in [p for p in dict.fromkeys(pieces) if p not in known]:
            if piece in old:
                self._keep(piece, old[piece])
            else:
                missing.append(piece)
        if missing:
            for piece, ids in zip(missing, self.encode(missing), strict=True):
                self._keep(piece, ids)
        found = [known[p] for p in pieces]
        count = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        ids = np.frombuffer(b"".join(found), np.int32)
        for piece in missing:
            if len(piece) > _LONGEST:
                self.held -= _size(piece, known.pop(piece))
        return ids, count

    def _keep(self, piece: bytes, ids: bytes) -> None:
        self.young[piece] = ids
        self.held += _size(piece, ids)


def _size(piece: bytes, ids: bytes) -> int:
    return _OVERHEAD + len(piece) + len(ids)
