"""Byte-level BPE by forced boundaries, over whole texts.

Two neighbouring bytes that no token of the vocabulary holds side by side are never merged, so the
text can be cut between them for certain: fragments are encoded on their own and their ids put one
after the other. Such cuts are found for a whole batch at once, by a table of 256 x 256 byte pairs.

They serve twice. Between a printable ASCII character and ASCII white space the split into
pre-tokens ends as well, whatever comes before or after; these cuts part a batch into pieces, each
of which is encoded once while a worker remembers it. Inside a piece the tokenizer's own
pre-tokenizer is asked, and its pre-tokens are cut at every forced pair. All fragments of a batch
are then merged side by side, in rounds over arrays. The strings of special tokens are found first, as the tokenizer does.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.pieces import MOST_BYTES, Pieces
from tallyline.llm.text_arrays import WHITE, groups, text_bytes

ENCODED = "doc_id long, n_tokens long, ids array<int>"
# Fragments of more bytes are merged with a heap.
SHORT = 64
# Pieces that go to the pre-tokenizer in one string.
RUN = 500
_NEVER = 1 << 62


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies.

    Visible bytes of Latin-1 stand for themselves, the others take the letters from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special strings of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, split = file["model"], file["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if file["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or not plain:
            raise ValueError("not a plain byte-level BPE file")
        letters = byte_letters()
        spelled = {token: bytes(letters[c] for c in token) for token in model["vocab"]}
        ids = model["vocab"]
        self.byte = [0] * 256
        for token, spelling in spelled.items():
            if len(spelling) == 1:
                self.byte[spelling[0]] = ids[token]
        # (left id, right id) -> rank and merged id, each pair and each result as one number.
        self.merges: dict[int, int] = {}
        made: dict[str, int] = {}  # rank of the first merge that gives a token
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            if max(made.get(a, -1), made.get(b, -1)) >= rank:
                raise ValueError("a merge comes before its parts")
            made.setdefault(a + b, rank)
            self.merges.setdefault(ids[a] << 32 | ids[b], rank << 32 | ids[a + b])
        self.special: dict[bytes, int] = {}
        tokens = {ids[t]: s for t, s in spelled.items()}
        for added in file["added_tokens"]:
            if any(added[k] for k in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError("added tokens must match exactly")
            text = added["content"]
            self.special[text.encode("utf-8")] = added["id"]
            known = all(c in letters for c in text)
            tokens[added["id"]] = bytes(letters[c] for c in text) if known else text.encode("utf-8")
        self.tokens = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        # Byte pairs that some token holds.
        self.inside = np.zeros((256, 256), bool)
        for spelling in spelled.values():
            both = np.frombuffer(spelling, np.uint8)
            self.inside[both[:-1], both[1:]] = True


def merge_long(ids: list[int], merges: dict[int, int]) -> list[int]:
    """Merge the ids of one fragment, in n log n steps: a heap over the ends of growing tokens.

    The pair of lowest rank, leftmost first, is merged until none has a rank. `stop[i]` is where the token that begins at i ends, `begin[e]` where the one that ends at e begins.
    """
    n = len(ids)
    stop, begin = list(range(1, n + 1)), list(range(-1, n))
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        """Offer the pair whose left token begins at i."""
        j = stop[i]
        if j < n and (found := merges.get(ids[i] << 32 | ids[j])) is not None:
            heapq.heappush(heap, (found, i, j, stop[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        found, i, j, end = heapq.heappop(heap)
        # Both tokens must still be what they were: as long as their ends are, they are.
        if stop[i] != j or stop[j] != end:
            continue
        ids[i], ids[j] = found & 0xFFFFFFFF, -1
        stop[i], stop[j], begin[end] = end, -1, i
        offer(i)
        if i:
            offer(begin[i])
    return [x for x in ids if x >= 0]


class Encoder:
    """Ids of texts; pieces are remembered between batches, in about `most` bytes."""

    def __init__(self, path: str, most: int = MOST_BYTES):
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        merges, byte = self.vocabulary.merges, self.vocabulary.byte
        self.pairs = np.array(sorted(merges), np.int64)
        self.results = np.array([merges[k] for k in self.pairs.tolist()], np.int64)
        self.byte_ids = np.array(byte, np.int64)
        self.byte_ranks = np.array([[merges.get(a << 32 | b, _NEVER) for b in byte] for a in byte], np.int64)
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.pieces = Pieces(self._encode, most)
        printable = np.zeros(256, bool)
        printable[0x21:0x7F] = True
        # Forced pairs at which the split into pre-tokens ends, too.
        self.apart = ~self.vocabulary.inside & printable[:, None] & WHITE[None, :]

    def pre_tokens(self, pieces: list[bytes]) -> np.ndarray:
        """Where the pre-tokens of `pieces`, put one after the other, begin.

        Pieces that begin and end like certain cuts can stand in one string, which saves a call for each.
        """
        alone = [not (WHITE[p[0]] and 0x21 <= p[-1] < 0x7F) for p in pieces]
        begins, base, k = [np.zeros(0, np.int64)], 0, 0
        while k < len(pieces):
            last = k + 1
            if not alone[k]:
                while last < len(pieces) and last - k < RUN and not alone[last]:
                    last += 1
            own = b"".join(pieces[k:last])
            spans = self.split(own.decode("utf-8"))
            letters = np.flatnonzero((np.frombuffer(own, np.uint8) & 0xC0) != 0x80)
            begins.append(base + letters[[a for _, (a, _) in spans]])
            base, k = base + len(own), last
        return np.concatenate(begins)

    def fragments(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of `pieces` and where fragments begin: at pre-tokens and at every forced pair."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.vocabulary.inside[data[:-1], data[1:]]
        cut[self.pre_tokens(pieces)] = True
        return data, np.flatnonzero(cut)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and merged id of each pair, as one number."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.results[at], _NEVER)

    def merge(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all fragments in turn, and how many each has.

        All fragments go on side by side: a round merges the pair of lowest rank of each, everywhere in it.
        A merge only makes pairs of higher ranks, so that is the order of one pair after the other.
        """
        size = np.diff(np.append(first, len(data)))
        owner = np.repeat(np.arange(len(first)), size)
        ids = self.byte_ids[data]
        ended = []
        for k in np.flatnonzero(size > SHORT).tolist():
            own = merge_long(ids[first[k] : first[k] + size[k]].tolist(), self.vocabulary.merges)
            ended.append((np.array(own, np.int64), np.full(len(own), k)))
        rank = np.full(len(data), _NEVER)
        rank[:-1] = self.byte_ranks[data[:-1], data[1:]]
        rank[np.append(first[1:], len(data)) - 1] = _NEVER
        short = (size <= SHORT)[owner]
        ids, owner, rank = ids[short], owner[short], rank[short]
        while len(ids):
            begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.append(begin, len(ids))))
            done = best == _NEVER
            ended.append((ids[done], owner[done]))
            ids, owner, rank, best = (x[~done] for x in (ids, owner, rank, best))
            at = np.flatnonzero(rank == best)
            if not len(at):
                break
            # Of pairs that overlap, as in aaa, every other one counts.
            fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
            at = at[(at - at[fresh][np.cumsum(fresh) - 1]) % 2 == 0]
            ids[at] = rank[at] & 0xFFFFFFFF
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            redo = np.concatenate([place[at], place[at] - 1])
            redo = redo[redo >= 0]
            rank[redo] = _NEVER
            redo = redo[redo < len(ids) - 1]
            redo = redo[owner[redo] == owner[redo + 1]]
            rank[redo] = self._ranks(ids[redo], ids[redo + 1])
        ids, owner = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*ended, strict=True))
        return ids[np.argsort(owner, kind="stable")].astype(np.int32), np.bincount(owner, minlength=len(first))

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as 4-byte integers."""
        special = self.vocabulary.special
        plain = [p for p in pieces if p not in special]
        found = {p: np.int32(special[p]).tobytes() for p in pieces if p in special}
        if plain:
            data, first = self.fragments(plain)
            ids, count = self.merge(data, first)
            upto = np.concatenate([[0], np.cumsum(count)])
            begin = np.searchsorted(first, np.cumsum([0, *map(len, plain)]))
            raw, cuts = ids.tobytes(), (4 * upto[begin]).tolist()
            found |= {p: raw[a:b] for p, a, b in zip(plain, cuts[:-1], cuts[1:], strict=True)}
        return [found[p] for p in pieces]

    def cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces begin: at certain cuts, around special strings and at the bounds of texts."""
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            cut[1:-1] = self.apart[data[:-1], data[1:]]
        raw = data.tobytes()
        for text in self.vocabulary.special:
            at = raw.find(text)
            while at >= 0:
                if np.searchsorted(bounds, at, "right") == np.searchsorted(bounds, at + len(text), "left"):
                    cut[at : at + len(text) + 1] = False
                    cut[[at, at + len(text)]] = True
                at = raw.find(text, at + len(text))
        cut[bounds] = True
        return np.flatnonzero(cut[:-1])

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in turn, and the ids each text begins at (one entry more)."""
        start = self.cuts(data, bounds)
        end = np.append(start[1:], len(data))[: len(start)]
        ids, upto = self.pieces.ids(data, start, end)
        return ids, upto[np.searchsorted(start, bounds)]


class Decoder:
    """Texts of ids; bytes that are no UTF-8 become replacement characters."""

    def __init__(self, path: str):
        tokens = Vocabulary(path).tokens
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        size = self.size[ids]
        upto = np.cumsum(size)
        if not len(ids):
            return ""
        source = np.repeat(self.first[ids] - upto + size, size) + np.arange(upto[-1])
        return self.bytes[source].tobytes().decode("utf-8", "replace")


_TOOLS: dict[tuple, Encoder | Decoder] = {}


def _tool(kind: type, path: str):
    """The tool of this Python worker, which keeps its pieces from task to task."""
    if (kind, path) not in _TOOLS:
        _TOOLS[kind, path] = kind(path)
    return _TOOLS[kind, path]


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, n_tokens, ids) of batches (doc_id, text)."""
    tool = _tool(Encoder, path)
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


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, n_tokens, ids) with the text of their ids."""
    tool = _tool(Decoder, path)
    for batch in batches:
        cuts = np.concatenate([[0], np.cumsum(batch.column(1).to_numpy())])
        ids = batch.column(2).flatten().to_numpy()
        texts = [tool.decode(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in range(3)), pa.array(texts, pa.string())],
            names=["doc_id", "n_tokens", "ids", "decoded"],
        )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each whole text, as the tokenizer of the file `path` gives them.

    `path` is a local path that all executors have. A null text counts as empty and has no ids; null
    or repeated document ids stay as they are, each row on its own; an empty table gives none. A text
    of any length is cut into pieces; its ids are one row. Extra columns are not read.
    """
    return _texts(docs).mapInArrow(lambda batches: _encoded(batches, path), ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` with the text of its ids, special tokens included, as `decoded`."""
    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(lambda batches: _decoded(batches, path), f"{ENCODED}, decoded string")


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """What :func:`decode` gives of :func:`encode`, in one Python worker a task."""
    return _texts(docs).mapInArrow(lambda batches: _decoded(_encoded(batches, path), path), f"{ENCODED}, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of decoded rows."""
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
