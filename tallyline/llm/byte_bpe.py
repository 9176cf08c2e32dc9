"""Byte-level BPE in two tiers, over whole texts.

Tier one: a minimal perfect hash over the byte strings of the vocabulary resolves a pre-token that
is itself a token. Tier two, for the rest: the bytes form a linked list, and a heap holds the rank
of each adjacent pair; the lowest rank, leftmost first, is merged until no pair has a rank.

A text is cut before each ASCII white space that follows something else, which the split pattern
never joins; each distinct piece is then split and encoded once while a worker remembers it.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.pieces import MOST_BYTES, Pieces
from tallyline.llm.text_arrays import WHITE, groups, mixed, range_hashes, text_bytes

ENCODED = "doc_id long, n_tokens long, ids array<int>"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash of byte strings: keys share buckets, a displacement places each bucket.

    `slots` holds the id at each place and `keys` the string, so a lookup compares the whole string.
    """

    def __init__(self, tokens: dict[bytes, int]):
        keys = list(tokens)
        self.n = max(1, len(keys))
        self.buckets = max(1, self.n // 3)
        h = hash_strings(keys)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        size = np.bincount(bucket, minlength=self.buckets)
        first = np.cumsum(size) - size
        self.shift = np.zeros(self.buckets, np.int64)
        taken = np.zeros(self.n, bool)
        place = np.zeros(len(keys), np.int64)
        tries = np.arange(256, dtype=np.uint64)[:, None]
        for b in np.argsort(-size, kind="stable").tolist():
            if size[b] < 2:
                break
            own, base = h[order[first[b] : first[b] + size[b]]], 0
            while True:
                at = self._slot(own, tries + np.uint64(base))
                ordered = np.sort(at, axis=1)
                good = np.flatnonzero(~taken[at].any(1) & (ordered[:, 1:] != ordered[:, :-1]).all(1))
                if len(good):
                    break
                base += len(tries)
            self.shift[b] = base + good[0]
            place[order[first[b] : first[b] + size[b]]] = at[good[0]]
            taken[at[good[0]]] = True
        # A key alone in its bucket takes a free place, which its bucket names as -1 - place.
        alone = np.flatnonzero(size == 1)
        free = np.flatnonzero(~taken)[: len(alone)]
        self.shift[alone] = -1 - free
        place[order[first[alone]]] = free
        self.keys = [b""] * self.n
        self.slots = np.full(self.n, -1, np.int64)
        for i, key in enumerate(keys):
            self.keys[place[i]] = key
            self.slots[place[i]] = tokens[key]

    def _slot(self, h: np.ndarray, step) -> np.ndarray:
        return (mixed(h ^ (step * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(self.n)).astype(np.int64)

    def find(self, strings: list[bytes]) -> np.ndarray:
        """The id of each string, -1 where it is not a key."""
        if not strings:
            return np.zeros(0, np.int64)
        h = hash_strings(strings)
        shift = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        at = np.where(shift < 0, -1 - shift, self._slot(h, np.maximum(shift, 0).astype(np.uint64)))
        same = np.fromiter((self.keys[k] == s for k, s in zip(at.tolist(), strings, strict=True)), bool, len(strings))
        return np.where(same, self.slots[at], -1)


def hash_strings(strings: list[bytes]) -> np.ndarray:
    """64-bit hashes of byte strings."""
    end = np.cumsum([len(s) for s in strings])
    start = np.concatenate([[0], end[:-1]]).astype(np.int64)
    return range_hashes(np.frombuffer(b"".join(strings), np.uint8), start, end)


class BytePairs:
    """Tier two: merges by rank over linked bytes.

    Pairs and heap entries are single integers: left id * 2**32 + right id, and rank * 2**32 + place.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.byte = [ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[int, int] = {}
        for key, rank in ranks.items():
            for cut in range(1, len(key)):
                a, b = ranks.get(key[:cut]), ranks.get(key[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 32 | b] = rank << 32

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        find = self.pairs.get
        push, pop = heapq.heappush, heapq.heappop
        byte = self.byte
        ids = [byte[b] for b in piece]
        n = len(ids)
        heap = []
        left = ids[0]
        for i in range(1, n):
            right = ids[i]
            if (rank := find(left << 32 | right)) is not None:
                heap.append(rank | (i - 1))
            left = right
        if not heap:
            return ids
        heapq.heapify(heap)
        after = [*range(1, n + 1)]
        before = [*range(-1, n - 1)]
        while heap:
            top = pop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            left = ids[i]
            if left < 0 or j >= n or find(left << 32 | ids[j]) != top - i:
                continue  # one of the two has been merged since
            new = top >> 32
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := find(new << 32 | ids[k])) is not None:
                    push(heap, rank | i)
            h = before[i]
            if h >= 0 and (rank := find(ids[h] << 32 | new)) is not None:
                push(heap, rank | h)
        return [x for x in ids if x >= 0]


def piece_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of pieces that the pattern never joins, and the pieces each text begins at.

    A cut lies before an ASCII white space that follows no white space. White space beyond ASCII
    ends in two or three known bytes; after a character that begins like one there is no cut.
    """
    n = len(data)
    white = WHITE[data]
    cut = np.zeros(n + 1, bool)
    cut[1:n] = white[1:] & ~white[:-1] & (data[:-1] > 0x20)  # nor after a control character
    first = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    cut[np.minimum(first + np.where(data[first] == 0xC2, 2, 3), n)] = False
    cut[bounds[bounds < n]] = True
    start = np.flatnonzero(cut[:n])
    return start, np.append(start[1:], n)[: len(start)], np.searchsorted(start, bounds)


class Encoder:
    """Ids of texts; pieces are remembered between batches, in about `most` bytes."""

    def __init__(self, path: str, pattern: str, most: int = MOST_BYTES):
        ranks = load_ranks(path)
        self.whole = PerfectHash(ranks)
        self.parts = BytePairs(ranks)
        self.split = regex.compile(pattern)
        self.pieces = Pieces(self._encode, most)

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as 4-byte integers."""
        split = [self.split.findall(p.decode("utf-8")) for p in pieces]
        tokens = list(dict.fromkeys(t for own in split for t in own))
        strings = [t.encode("utf-8") for t in tokens]
        found = self.whole.find(strings).tolist()
        merge = self.parts.encode
        ids = {t: ([i] if i >= 0 else merge(s)) for t, s, i in zip(tokens, strings, found, strict=True)}
        return [array("i", [i for t in own for i in ids[t]]).tobytes() for own in split]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in turn, and the ids each text begins at (one entry more)."""
        start, end, firsts = piece_bounds(data, bounds)
        ids, upto = self.pieces.ids(data, start, end)
        return ids, upto[firsts]


class Decoder:
    """Bytes of ids."""

    def __init__(self, path: str):
        token = {rank: key for key, rank in load_ranks(path).items()}
        self.size = np.array([len(token.get(i, b"")) for i in range(max(token) + 1)], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(token.get(i, b"") for i in range(len(self.size))), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of `ids`."""
        size = self.size[ids]
        upto = np.cumsum(size)
        if not len(ids):
            return b""
        source = np.repeat(self.first[ids] - upto + size, size) + np.arange(upto[-1])
        return self.bytes[source].tobytes()


_TOOLS: dict[tuple, Encoder | Decoder] = {}


def _tool(kind: type, *made_of: str):
    """The tool of this Python worker; an encoder keeps its pieces from task to task."""
    if (kind, *made_of) not in _TOOLS:
        _TOOLS[kind, *made_of] = kind(*made_of)
    return _TOOLS[kind, *made_of]


def _encoded(batches: Iterator[pa.RecordBatch], ranks: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, n_tokens, ids) of batches (doc_id, text)."""
    tool = _tool(Encoder, ranks, pattern)
    for batch in batches:
        data, bounds = text_bytes(batch.column(1))
        for a, b in groups(bounds, 1 << 20):
            ids, firsts = tool.encode(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
            lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.diff(firsts), pa.int64()), lists],
                names=["doc_id", "n_tokens", "ids"],
            )
    pa.default_memory_pool().release_unused()


def _decoded(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, n_tokens, ids) with the bytes of their ids."""
    tool = _tool(Decoder, ranks)
    for batch in batches:
        lists = batch.column(2)
        ids, cuts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(batch.column(1).to_numpy())])
        bodies = [tool.decode(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in range(3)), pa.array(bodies, pa.binary())],
            names=["doc_id", "n_tokens", "ids", "decoded"],
        )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each whole text.

    `ranks` is the path of a rank file, a local path that all executors have. A null text counts
    as empty and has no ids; null or repeated document ids stay as they are, each row on its own;
    an empty table gives none. Extra columns are not read.
    """
    return _texts(docs).mapInArrow(lambda batches: _encoded(batches, ranks, pattern), ENCODED)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """`encoded` with the bytes of its ids as `decoded`."""
    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(lambda batches: _decoded(batches, ranks), f"{ENCODED}, decoded binary")


def encode_decode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """What `decode` gives of `encode`, in one Python worker a task instead of two."""
    return _texts(docs).mapInArrow(
        lambda batches: _decoded(_encoded(batches, ranks, pattern), ranks), f"{ENCODED}, decoded binary"
    )


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of decoded rows."""
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
