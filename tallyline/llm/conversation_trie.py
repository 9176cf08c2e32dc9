"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path: the digests of its turns, 16 bytes each, one after the other. Paths and
conversation ids are cut into ranges by splitters from a sample. A node whose path is no prefix of
a splitter's has all its members in one range, where a single pass over the sorted paths finishes
it. The prefixes of all splitters are the skeleton, a small trie that every task knows: for its
nodes each range gives a partial aggregate, and these are added up per node and then along the
skeleton. A path that a third of all conversations share lies in many ranges, since splitters tell
equal paths apart by conversation id.

A turn is known by the MD5 of its role and text. A task holds one conversation at a time, 20 bytes
a turn, and the finished children of nodes still open in its range. The digest of the ids that end
at a skeleton node is read in order by one task, in pieces of many ids each.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storage import stored

TURN = 16
# Bytes of paths in a range, ranges at most, sampled paths for each, and turns of a splitter.
RANGE_BYTES, MOST_RANGES, PER_RANGE, SPLITTER_TURNS = 4 << 20, 10_000, 8, 64
# Ids in a piece of a skeleton node's digest.
PIECE_IDS = 2000
_LEAST = -(1 << 63)

PATHS = "conv_id long, path binary, chars binary"
_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_FOUND = f"{_NODE}, node int, shard int, piece int, ids binary"


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that tell (role, text) apart; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text))))


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, chars) of each conversation, turns in order of `turn`, null first.

    Turns with equal numbers go by their digest. Rows without `conv_id` belong to no conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, path, chars = None, bytearray(), bytearray()
        ready: tuple[list, list, list] = ([], [], [])

        def keep() -> None:
            for column, value in zip(ready, (at, bytes(path), bytes(chars)), strict=True):
                column.append(value)

        def given() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.binary(), pa.binary())
            columns = [pa.array(x, kind) for x, kind in zip(ready, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "path", "chars"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            keys = b"".join(batch.column(1).to_pylist())
            sizes = batch.column(2).to_numpy().astype("<i4").tobytes()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if at is not None and ids[a] != at:
                    keep()
                    path, chars = bytearray(), bytearray()
                at = int(ids[a])
                path += keys[TURN * a : TURN * b]
                chars += sizes[4 * a : 4 * b]
            yield given()
            ready = ([], [], [])
        if at is not None:
            keep()
            yield given()

    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        turn_digest(F.col("role"), F.col("text")).alias("key"),
        F.length(F.coalesce("text", F.lit(""))).alias("chars"),
        "turn",
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "key")
    return ordered.select("conv_id", "key", "chars").mapInArrow(run, PATHS)


def rebuilt(own: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """`own` with the first h turns taken from conversation c - c % `group`, h = crc32(c) % `most`.

    The conversation keeps its own turns after its first h; without the other one it has those alone.
    """
    first = most - 1
    heads = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("head"),
        F.substring("path", 1, TURN * first).alias("head_path"),
        F.substring("chars", 1, 4 * first).alias("head_chars"),
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    empty = F.lit(b"")

    def joined(head: str, name: str, width: int) -> Column:
        start = F.coalesce(F.substr(F.col(head), F.lit(1), (h * width).cast("int")), empty)
        return F.concat(start, F.substr(F.col(name), (h * width + 1).cast("int"))).alias(name)

    based = own.withColumn("head", F.col("conv_id") - F.col("conv_id") % group).join(heads, "head", "left")
    return based.select("conv_id", joined("head_path", "path", TURN), joined("head_chars", "chars", 4))


class Skeleton:
    """The trie of splitter paths. Nodes are numbers, the root is 0; a parent comes before its children."""

    def __init__(self, splitters: list[tuple[bytes, bytes]]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth, self.chars = [-1], [0], [0]
        for path, chars in splitters:
            node = 0
            for i in range(len(path) // TURN):
                key = (node, path[TURN * i : TURN * (i + 1)])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(i + 1)
                    self.chars.append(int.from_bytes(chars[4 * i : 4 * i + 4], "little"))
                node = self.child[key]

    def along(self, path: bytes) -> list[int]:
        """The skeleton nodes of a path, from the root on."""
        nodes = [0]
        for i in range(len(path) // TURN):
            node = self.child.get((nodes[-1], path[TURN * i : TURN * (i + 1)]))
            if node is None:
                break
            nodes.append(node)
        return nodes


class _Open:
    """A node that may still gain members. `node` is its number in the skeleton, -1 outside."""

    __slots__ = ("node", "depth", "chars", "least", "convs", "children", "leaves", "saved", "sha", "ready")

    def __init__(self, node: int, depth: int, chars: int):
        self.node, self.depth, self.chars = node, depth, chars
        self.least: int | None = None
        self.convs = self.children = self.leaves = self.saved = 0
        self.sha = hashlib.sha256()
        self.ready: list[tuple] = []  # finished children outside the skeleton, which wait for `least`

    def meet(self, least: int, convs: int) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.convs += convs


class _Range:
    """One pass over the sorted conversations of a range."""

    def __init__(self, skeleton: Skeleton, shard: int):
        self.skeleton, self.shard = skeleton, shard
        self.path = b""
        self.stack = [_Open(0, 0, 0)]
        self.out: list[tuple] = []
        self.ids: list[int] = []  # of the skeleton node that ends are met at
        self.piece = 0

    def add(self, conv_id: int, path: bytes, chars: bytes) -> None:
        if path != self.path:
            self._pieces()
            same, most = 0, min(len(path), len(self.path)) // TURN
            while same < most and path[TURN * same : TURN * (same + 1)] == self.path[TURN * same : TURN * (same + 1)]:
                same += 1
            while len(self.stack) > same + 1:
                self._close()
            for depth in range(same + 1, len(path) // TURN + 1):
                above = self.stack[-1].node
                key = (above, path[TURN * (depth - 1) : TURN * depth])
                node = self.skeleton.child.get(key, -1) if above >= 0 else -1
                self.stack.append(_Open(node, depth, int.from_bytes(chars[4 * depth - 4 : 4 * depth], "little")))
            self.path = path
        top = self.stack[-1]
        if top.node >= 0:
            self.ids.append(conv_id)
            if len(self.ids) >= PIECE_IDS:
                self._pieces()
        else:
            top.sha.update(b",%d" % conv_id if top.convs else b"%d" % conv_id)
        top.meet(conv_id, 1)

    def _pieces(self) -> None:
        """Give out the ids that ended at the skeleton node on top."""
        if self.ids:
            body = ",".join(map(str, self.ids)).encode()
            self.out.append((None,) * 8 + (self.stack[-1].node, self.shard, self.piece, body))
            self.ids = []
            self.piece += 1

    def _close(self) -> None:
        """The node on top has all its members of this range."""
        node = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        self.out += [(*row[:2], node.least, *row[3:]) if node.node < 0 else row for row in node.ready]
        if node.node >= 0:
            # A partial aggregate; members that lie below other skeleton nodes are added along the skeleton.
            self.out.append((node.least, node.depth, None, node.convs, node.children, node.leaves, node.saved, None, node.node, None, None, None))
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.convs - 1) * node.chars
        row = (node.least, node.depth, None, node.convs, node.children, leaves, saved, node.sha.hexdigest())
        if above.node >= 0:
            self.out.append((*row, above.node, None, None, None))
        else:
            above.ready.append((*row, None, None, None, None))
        above.meet(node.least, node.convs)
        above.children += 1
        above.leaves += leaves
        above.saved += saved

    def end(self) -> None:
        self._pieces()
        while self.stack:
            self._close()


_KINDS = [pa.int64()] * 7 + [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_NAMES = [x.split()[0] for x in _FOUND.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_NAMES
    )


def _splitters(rows: DataFrame, ranges: int) -> list[tuple[bytes, int, bytes]]:
    """At most `ranges` - 1 splitters (path, conv_id, chars), ascending, from a sample by hash."""
    if ranges < 2:
        return []
    sample = (
        rows.select(
            F.substring("path", 1, TURN * SPLITTER_TURNS).alias("path"),
            F.when(F.length("path") <= TURN * SPLITTER_TURNS, F.col("conv_id")).otherwise(F.lit(_LEAST)).alias("conv_id"),
            F.substring("chars", 1, 4 * SPLITTER_TURNS).alias("chars"),
            F.xxhash64("conv_id").alias("order"),
        )
        .orderBy("order", "conv_id")
        .limit(ranges * PER_RANGE)
        .select("path", "conv_id", "chars")
        .toArrow()
        .to_pydict()
    )
    found = sorted(zip(sample["path"], sample["conv_id"], sample["chars"], strict=True))
    return sorted({found[len(found) * k // ranges] for k in range(1, ranges)}) if found else []


def _finished(rows: DataFrame, splitters: list[tuple[bytes, int, bytes]], skeleton: Skeleton) -> DataFrame:
    """Rows of finished nodes, of partial aggregates and of pieces of digests, stored.

    A finished node has a digest, and `node` if its parent is in the skeleton; a partial aggregate has
    only `node`, a piece has `ids`.
    """
    spark = rows.sparkSession
    known = spark.sparkContext.broadcast((sorted((p, c) for p, c, _ in splitters), skeleton))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = known.value[0]
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
            shard = pa.array([bisect_right(cuts, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=["conv_id", "path", "chars", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, now = known.value[1], None
        for batch in batches:
            for conv_id, path, chars, shard in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if now is None or shard != now.shard:
                    if now is not None:
                        now.end()
                        yield _batch(now.out)
                    now = _Range(trie, shard)
                now.add(conv_id, path, chars)
                if len(now.out) >= 4096:
                    yield _batch(now.out)
                    now.out = []
        if now is not None:
            now.end()
            yield _batch(now.out)

    dealt = rows.mapInArrow(deal, f"{PATHS}, shard int").repartitionById(len(splitters) + 1, F.col("shard"))
    return stored(dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(run, _FOUND), "trie-parts")


def _digests(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the ids that end at skeleton nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None
        done: list[tuple[int, str]] = []
        for batch in batches:
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if node != at:
                    if at is not None:
                        done.append((at, sha.hexdigest()))
                    at, sha = node, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.as_buffer())
        if at is not None:
            done.append((at, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in done], pa.int32()), pa.array([x[1] for x in done], pa.string())], names=["node", "ends_sha256"]
        )

    ordered = pieces.repartition("node").sortWithinPartitions("node", "shard", "piece")
    return ordered.select("node", "ids").mapInArrow(run, "node int, ends_sha256 string")


def trie(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """The nodes of the trie of `rows` (conv_id, path, chars), one row each.

    conv_id (smallest member), depth, parent_conv_id (of the root null), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Conversations without turns are members of the root alone. Without conversations
    there are no nodes.
    """
    spark = rows.sparkSession
    size, n = rows.agg(F.sum(F.length("path")), F.count("*")).first()
    if not n:
        return spark.createDataFrame([], _NODE)
    if ranges is None:
        ranges = min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES)))
    splitters = _splitters(rows, ranges)
    skeleton = Skeleton([(path, chars) for path, _, chars in splitters])
    parts = _finished(rows, splitters, skeleton)

    partial = parts.where("ids is null and ends_sha256 is null").groupBy("node").agg(
        F.min("conv_id").alias("least"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    digests = _digests(parts.where("ids is not null").select("node", "shard", "piece", "ids"))
    # One row for each node of the skeleton, whose size the splitters bound.
    sums = partial.join(digests, "node", "left").toArrow().to_pylist()
    top = _skeleton_rows(skeleton, {r["node"]: r for r in sums})
    names = spark.createDataFrame([(node, row[0]) for node, row in enumerate(top)], "node int, above long")
    local = parts.where("ids is null and ends_sha256 is not null").join(F.broadcast(names), "node", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    columns = [x.split()[0] for x in _NODE.split(", ")]
    return local.select(*columns).unionByName(spark.createDataFrame(top, _NODE))


def _skeleton_rows(skeleton: Skeleton, sums: dict[int, dict]) -> list[tuple]:
    """The rows of all skeleton nodes, from the sums of their partial aggregates."""
    n = len(skeleton.parent)
    none = hashlib.sha256(b"").hexdigest()
    least = [sums[k]["least"] if k in sums else None for k in range(n)]
    convs, children, leaves, saved = (
        [sums[k][c] if k in sums else 0 for k in range(n)] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")
    )
    for k in reversed(range(n)):
        leaves[k] = leaves[k] if children[k] else 1
        saved[k] += (convs[k] - 1) * skeleton.chars[k]
        up = skeleton.parent[k]
        if up >= 0:
            known = [x for x in (least[up], least[k]) if x is not None]
            least[up] = min(known)
            convs[up] += convs[k]
            children[up] += 1
            leaves[up] += leaves[k]
            saved[up] += saved[k]
    return [
        (
            least[k], skeleton.depth[k], least[skeleton.parent[k]] if k else None, convs[k], children[k], leaves[k], saved[k],
            (sums[k]["ends_sha256"] if k in sums else None) or none,
        )
        for k in range(n)
    ]


def conversation_trie(conversations: DataFrame, ranges: int | None = None) -> DataFrame:
    """The trie of the rebuilt `conversations` (conv_id, turn, role, text): see :func:`rebuilt` and :func:`trie`.

    Null roles and texts count as empty, equal rows are turns of their own, rows without `conv_id` are left out. Extra
    columns are not read.
    """
    own = stored(paths(conversations), "conversation-paths")
    return trie(stored(rebuilt(own), "rebuilt-paths"), ranges)
