"""Near-duplicate documents by an exact Jaccard join on word n-grams.

Two documents link when the Jaccard similarity of their sets of distinct shingles is at least
`percent` / 100. Documents with equal sets are one class. Shingles are ordered rare first, by their
counts over all documents (kept in a table of fixed size, where shingles may share a count; any
order gives right results, a rarer-first one fewer candidates). Linked sets of n and m shingles
share one among the first n - ceil(t n) + 1 of this order, so classes are candidates only if they
meet under such a prefix shingle, their sizes allow the similarity, and so do their
places in the order at the shingle where they meet.

`links` gives every link between classes, `linked_documents` what follows from them for each document.
In a group of many near copies of different texts their number is the square of its size.

`near_duplicates` needs the components of links, not each link, so it leaves out pairs inside a component:
first each class meets only a few pivots of the largest groups it is in; once what links has merged,
the rest meets everything of other components that shares a prefix shingle with it, without
exception. No link between different components is lost, and a group of thousands of near copies
costs about its size instead of its square. A pair is verified once, on the whole sets, after a
suffix filter that bounds their overlap by halves.

Null texts and texts without words have an empty set and link with nothing; a text of fewer words than
a shingle has its whole sequence as the only one. Null ids stay null and take part with their text; a
component whose ids are all null has a null id. Repeated rows are each kept. An empty table gives none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.graph import components
from tallyline.llm.shingles import shingle_sets
from tallyline.llm.storage import stored
from tallyline.llm.text_arrays import groups, mixed, text_bytes

BUCKET_BITS = 20
CHUNK = 1 << 10
FEW = 1_000_000


def class_id(shingles: np.ndarray) -> int:
    """A 64-bit id of a set of shingles; 0 for the empty set."""
    if not len(shingles):
        return 0
    both = np.array([shingles.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(shingles))], np.uint64)
    both = mixed(both + np.array([len(shingles), 1], np.uint64))
    return int(mixed(both[:1] ^ (both[1:] << np.uint64(1)))[0].astype(np.int64)) or 1


def _sets(batches: Iterator[pa.RecordBatch], column: int, size: int):
    """(batch, first row, sets) over all texts, those of about a megabyte at a time."""
    for batch in batches:
        data, bounds = text_bytes(batch.column(column))
        for a, b in groups(bounds, 1 << 20):
            yield batch, a, list(shingle_sets(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], size))
    pa.default_memory_pool().release_unused()


def _measure(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, n, c) of all documents, and rows (chunk, counts) of the count tables of tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Above 255 in one task a count only has to be large.
        table = np.zeros(1 << BUCKET_BITS, np.uint8)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        names = ["doc_id", "n", "c", "chunk", "counts"]

        def rows(*columns):
            n = len(next(x for x in columns if x is not None))
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, k) if x is None else pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch, a, sets in _sets(batches, 1, size):
            every = np.concatenate([*sets, np.zeros(0, np.uint64)])
            at, more = np.unique((every >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), return_counts=True)
            table[at] = np.minimum(table[at] + more, 255)
            yield rows(batch.column(0).slice(a, len(sets)), [len(s) for s in sets], [class_id(s) for s in sets], None, None)
        small = table.reshape(-1, CHUNK)
        used = np.flatnonzero(small.any(1))
        if len(used):
            yield rows(None, None, None, used, [small[i].tobytes() for i in used])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, c long, chunk int, counts binary"
    )


def _levels(measured: DataFrame) -> np.ndarray:
    """Rough logarithms of the counts of all buckets, as one byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if chunk != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()])], names=["chunk", "sums"])
                    at, total = chunk, np.zeros(CHUNK, np.int64)
                total += np.frombuffer(counts.as_py(), np.uint8)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()])], names=["chunk", "sums"])

    sums = (
        measured.where("chunk is not null")
        .select("chunk", "counts")
        .repartition("chunk")
        .sortWithinPartitions("chunk")
        .mapInArrow(run, "chunk int, sums binary")
    )
    levels = np.zeros(1 << BUCKET_BITS, np.uint8)
    for r in sums.toLocalIterator():  # the table has a fixed size
        total = np.frombuffer(r.sums, np.int64)
        levels[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.minimum(255, np.log2(total + 1) * 8)
    return levels


def prefix(shingles: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The prefix of a set in rare-first order, as keys that ascend in this order."""
    level = levels[(shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64)
    keys = np.sort((level << np.uint64(56)) | (shingles & np.uint64((1 << 56) - 1)))
    return keys[: len(keys) - -(-percent * len(keys) // 100) + 1]


def _prefixes(docs: DataFrame, levels: np.ndarray, size: int, percent: int) -> DataFrame:
    """(token, c, pos): the prefix of each class, from each task that has a document of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, _, sets in _sets(batches, 0, size):
            tokens, owners, places = [], [], []
            for s in sets:
                own = class_id(s)
                if own and own not in seen:
                    seen.add(own)
                    tokens.append(prefix(s, levels, percent))
                    owners.append(np.full(len(tokens[-1]), own))
                    places.append(np.arange(len(tokens[-1]), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(owners)), pa.array(np.concatenate(places))],
                    names=["token", "c", "pos"],
                )

    return docs.select("text").mapInArrow(run, "token long, c long, pos int")


def _few(ids: DataFrame) -> DataFrame:
    """Broadcast if there are few rows; beyond that a shuffle does the same."""
    return F.broadcast(ids) if ids.count() <= FEW else ids


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(c, shingles) of the classes in `wanted` (c), from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, _, sets in _sets(batches, 0, size):
            ids, bodies = [], []
            for s in sets:
                own = class_id(s)
                if own and own not in seen:
                    seen.add(own)
                    ids.append(own)
                    bodies.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bodies, pa.binary())], names=["c", "shingles"])

    found = docs.select("text").mapInArrow(run, "c long, shingles binary").join(_few(wanted), "c", "left_semi")
    return found.groupBy("c").agg(F.first("shingles").alias("shingles"))


def overlap_bound(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    """At least the size of the intersection of two ascending arrays, from the sizes of parts."""
    if not depth or not len(x) or not len(y):
        return min(len(x), len(y))
    half = len(y) // 2
    cut = int(np.searchsorted(x, y[half]))
    return overlap_bound(x[:cut], y[:half], depth - 1) + overlap_bound(x[cut:], y[half:], depth - 1)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ascending arrays have the similarity."""
    total = len(x) + len(y)
    if overlap_bound(x, y, 3) * (100 + percent) < percent * total:
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (total - common)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = [
                linked(np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64), percent)
                for p, q in zip(x, y, strict=True)
            ]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in range(2)], names=["a", "b"])

    a = sets.select(F.col("c").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("c").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _meeting(left: DataFrame, right: DataFrame, percent: int, extra) -> DataFrame:
    """(a, b), a < b: classes of different components that meet and pass the size and place filters."""
    x, y = left.alias("x"), right.alias("y")
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    most = 1 + F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) - 1
    meet = (
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.component") != F.col("y.component"))
        & (100 * small >= percent * large)
        & (most * (100 + percent) >= percent * (F.col("x.n") + F.col("y.n")))
        & extra(F.col("x.c"), F.col("y.c"), F.col("y.rest"))
    )
    return x.join(y, meet).select(F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b")).distinct()


def _shared(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, c) of all documents; (token, c, pos, n): prefix shingles that several classes have."""
    measured = stored(_measure(docs, size), "shingle-counts")
    rows = measured.where("chunk is null").select("doc_id", "n", "c")
    sizes = rows.where("c <> 0").select("c", "n").distinct()
    # One shuffle of all prefixes; what only one class has goes before anything else is done.
    own = Window.partitionBy("token")
    met = _prefixes(docs, _levels(measured), size, percent).select(
        "token", "c", "pos", F.min("c").over(own).alias("lo"), F.max("c").over(own).alias("hi")
    )
    shared = met.where("lo <> hi").select("token", "c", "pos").distinct().join(sizes, "c").select("token", "c", "pos", "n")
    return rows, stored(shared, "shared-prefixes")


def _found(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The stored pairs (a, b) that link."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct(), "pair-classes")
    # Both sides of the verification read the one shuffle by class that makes the sets unique.
    sets = _sets_of(docs, wanted, size)
    return stored(_verified(pairs, sets, percent), "links")


def _labels(links: DataFrame) -> DataFrame:
    """(id, component) of the classes that link."""
    return stored(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "components")


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """`rows` (doc_id, n, c, ..) as (doc_id, n_shingles, component_id, ..)."""
    more = [x for x in rows.columns if x not in ("doc_id", "n", "c")]
    named = rows.join(labels.select(F.col("id").alias("c"), "component"), "c", "left").withColumn(
        "component", F.coalesce("component", "c")
    )
    full = named.where("c <> 0")
    smallest = full.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (
        full.join(smallest, "component")
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", *more)
        .unionByName(
            named.where("c = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *more)
        )
    )


def _every_link(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, c) of all documents, and all links (a, b) between their classes, a < b."""
    rows, shared = _shared(docs, size, percent)
    every = shared.withColumn("component", F.col("c")).withColumn("rest", F.lit(True))
    pairs = stored(_meeting(every, every, percent, lambda x, y, rest: x < y), "pairs")
    return rows, _found(docs, pairs, size, percent)


def _members(rows: DataFrame) -> DataFrame:
    """(c, doc_id, n_docs): the smallest id of each class with shingles, and its number of rows."""
    return rows.where("c <> 0").groupBy("c").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_docs"))


def links(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_a, doc_b, n_docs_a, n_docs_b): each link between two classes of equal sets, once.

    A class is named by its smallest id and comes with its number of rows, all of which link with each other
    and with all of the other class.
    """
    rows, found = _every_link(docs, size, percent)
    members = _members(rows)
    for k in "ab":
        named = members.select(F.col("c").alias(k), F.col("doc_id").alias(f"doc_{k}"), F.col("n_docs").alias(f"n_docs_{k}"))
        found = found.join(named, k)
    return found.select("doc_a", "doc_b", "n_docs_a", "n_docs_b")


def linked_documents(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every document: how many other rows it links with."""
    rows, found = _every_link(docs, size, percent)
    members = _members(rows).select("c", "n_docs")
    ends = found.select("a", "b").unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(members.withColumnRenamed("c", "b"), "b").groupBy("a").agg(F.sum("n_docs").alias("others"))
    per = members.join(others.withColumnRenamed("a", "c"), "c", "left")
    per = per.select("c", (F.col("n_docs") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    counted = rows.join(per, "c", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    return _named(counted, _labels(found))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, pivots: tuple[int, ...] = (8, 64)) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    rows, shared = _shared(docs, size, percent)
    # The two largest groups that a class is in; classes of a large group of copies agree on them.
    per = shared.groupBy("token").agg(F.count("*").alias("group"))
    order = Window.partitionBy("c").orderBy(F.desc("group"), "token")
    hubs = stored(
        shared.join(per, "token").withColumn("k", F.row_number().over(order)).where("k <= 2").select("token", "c", "pos", "n"),
        "hub-prefixes",
    )
    linking, labels, done = None, None, None
    for k in (*pivots, None):
        base = shared if k is None else hubs
        if labels is not None:
            known = labels.select(F.col("id").alias("c"), "component")
            base = base.join(known, "c", "left").withColumn("component", F.coalesce("component", "c"))
        else:
            base = base.withColumn("component", F.col("c"))
        several = base.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
        base = base.join(several.select("token"), "token", "left_semi")
        if k is not None:
            chosen = Window.partitionBy("token").orderBy(F.xxhash64(F.lit(k), "c"), "c")
            first = base.withColumn("k", F.row_number().over(chosen)).where(F.col("k") <= k).drop("k")
            pairs = _meeting(first.withColumn("rest", F.lit(True)), base.withColumn("rest", F.lit(True)), percent, lambda x, y, rest: x != y)
        else:
            # Within the largest component of a group nothing is left to find, so only the rest asks.
            counted = base.groupBy("token", "component").agg(F.count("*").alias("m"))
            largest = counted.groupBy("token").agg(F.max_by("component", F.struct("m", "component")).alias("largest"))
            base = base.join(largest, "token").withColumn("rest", F.col("component") != F.col("largest"))
            pairs = _meeting(base.where("rest"), base, percent, lambda x, y, rest: ~rest | (x < y))
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = _found(docs, pairs, size, percent)
        done = pairs if done is None else done.unionByName(pairs)
        linking = found if linking is None else linking.unionByName(found)
        labels = _labels(linking)
    return _named(rows, labels)


def drop_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component of `docs`, that of the smallest `doc_id`, null last; rows without words stay.

    Rows are told apart by a number of their own, so rows that share an id or have none are as good as any.
    """
    row = f"row_{uuid.uuid4().hex}"
    # Stored, so that a row keeps its number however often it is read.
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    rows = numbered.select(F.col(row).alias("doc_id"), "text")
    found = near_duplicates(rows, size, percent).select(F.col("doc_id").alias(row), "component_id")
    several = found.where(F.col(row) != F.col("component_id")).select("component_id").distinct()
    members = found.join(several, "component_id").join(numbered.select(row, "doc_id"), row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row))
    kept = members.groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{row}").alias(row))
    gone = stored(members.select(row).join(kept, row, "left_anti"), "near-duplicates")
    return numbered.join(_few(gone), row, "left_anti").select(*docs.columns)
