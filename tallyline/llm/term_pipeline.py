"""Ranked lexical search by pipelined term partitioning.

Documents are read in blocks; a block gives one packed posting list for each of its terms. Terms
have owners, bands of document frequency, rarest first. Items travel in bundles: for each block a
bundle goes through one owner after the other, and at each a cogroup brings it together with the
owner's postings of that block, whose integer contributions are added to the bundle's sparse
document accumulators. After the last owner each block keeps the best k documents of each item, and
the best k of those are the answer.

Between owners an accumulator is dropped when what the later owners can still add, at most 10**6
for each unit of weight, leaves its document behind k others of its block. Such a document may
come back later with less than its score; it then is behind them all the same.

A bundle and a block are bounded, whatever the tables: a frequent term has one posting list in each
block. Terms are 64-bit hashes of lower-cased words, equal for different words with a chance of
about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.storage import stored
from tallyline.llm.text_arrays import LOWER, groups, range_hashes, text_bytes, word_bounds

# Bytes that part terms: all of ASCII but letters and digits.
BLANK = np.ones(256, bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    BLANK[_first : _last + 1] = False

# Fixed values of the score: length weight in percent, scale of a term's weight, of its
# contribution and of its frequency, and the factor of the length.
LENGTH_PERCENT = 75
WEIGHT_SCALE = 1000
GAIN, TF_SCALE, LENGTH_SCALE = 1_000_000_000, 1000, 8
MOST_GAIN = GAIN // TF_SCALE

# Sizes of a block and of a bundle.
BLOCK_DOCS, BLOCK_BYTES = 8192, 4 << 20
BUNDLE_PAIRS, BUNDLE_ITEMS = 20_000, 256
# Owners: terms in at most these shares of all documents, and the rest.
BANDS = (0.001, 0.02)
# Up to so many distinct item terms the tasks that read documents know them and keep no others.
FEW_TERMS = 1_000_000

_INDEX = "block long, term long, n long, docs binary, tf binary, doc_ids array<long>, lengths binary"
_LEFT = "bundle long, block long, rest array<struct<slot:int,stage:int,bound:long>>, lengths binary, slots binary, docs binary, scores binary"

_REST = pa.list_(pa.struct([("slot", pa.int32()), ("stage", pa.int32()), ("bound", pa.int64())]))


def _windows(data: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of about `most` bytes that cut no term."""
    first = 0
    while first < len(data):
        last = min(first + most, len(data))
        if last < len(data):
            before = np.flatnonzero(BLANK[data[first:last]])
            after = before if len(before) else np.flatnonzero(BLANK[data[last:]])
            last = first + before[-1] + 1 if len(before) else (last + after[0] + 1 if len(after) else len(data))
        yield first, int(last)
        first = int(last)


def _term_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each term of all texts, and the terms each text begins at."""
    start, end, firsts = word_bounds(data, bounds, BLANK)
    return range_hashes(LOWER[data], start, end), firsts


class _Wanted:
    """The terms that are kept, all if there is no list."""

    def __init__(self, terms: np.ndarray | None):
        self.terms = None if terms is None else np.sort(terms.view(np.uint64))
        if terms is not None:
            self.maybe = np.zeros(1 << 16, bool)
            self.maybe[(self.terms & np.uint64(0xFFFF)).astype(np.int64)] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Which of `hashes` are kept."""
        if self.terms is None:
            return np.arange(len(hashes))
        at = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        if not len(self.terms):
            return at[:0]
        place = np.minimum(np.searchsorted(self.terms, hashes[at]), len(self.terms) - 1)
        return at[self.terms[place] == hashes[at]]


def _counted(data: np.ndarray, bounds: np.ndarray, wanted: _Wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms in each text), and (term, text, frequency) of kept terms, by term and text."""
    n = len(bounds) - 1
    lengths = np.zeros(n, np.int64)
    terms, docs, counts = [], [], []
    whole = [(0, len(data))] if n > 1 or len(data) <= BLOCK_BYTES else _windows(data, BLOCK_BYTES)
    for a, b in whole:
        hashes, firsts = _term_hashes(data[a:b], bounds if n > 1 else np.array([0, b - a]))
        lengths += np.diff(firsts)
        kept = wanted.places(hashes)
        owner = np.searchsorted(firsts, kept, "right") - 1
        term, which = np.unique(hashes[kept], return_inverse=True)
        keys, count = np.unique(which * n + owner, return_counts=True)
        terms.append(term[keys // n])
        docs.append(keys % n)
        counts.append(count)
    term, doc, count = np.concatenate(terms), np.concatenate(docs), np.concatenate(counts)
    if len(terms) > 1:  # one long text in several windows
        term, which = np.unique(term, return_inverse=True)
        count = np.bincount(which, count, len(term)).astype(np.int64)
        doc = np.zeros(len(term), np.int64)
    return lengths, term, doc, count


def _packed(values: np.ndarray) -> bytes:
    """Counts as bytes if all fit, else as 4-byte integers."""
    return values.astype(np.uint8 if values.max(initial=0) < 256 else np.uint32).tobytes()


def _unpacked(body: bytes, n: int) -> np.ndarray:
    return np.frombuffer(body, np.uint8 if len(body) == n else np.uint32).astype(np.int64)


def index(docs: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """The stored index of `docs` (doc_id, text), of the given term hashes or of all terms.

    Rows with `doc_ids` describe a block: its ids in ascending order, null first, and the terms of each document.
    Other rows are the postings of one term in one block: places in that order, and frequencies.
    """
    known = None if terms is None else docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Wanted(None if known is None else known.value)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for a, b in groups(bounds, BLOCK_BYTES):
                for first in range(a, b, BLOCK_DOCS):
                    last = min(first + BLOCK_DOCS, b)
                    ids = batch.column(0).slice(first, last - first)
                    yield from rows(block, ids, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], wanted)
                    block += 1
        pa.default_memory_pool().release_unused()

    def rows(block: int, ids: pa.Array, data: np.ndarray, bounds: np.ndarray, wanted: _Wanted) -> Iterator[pa.RecordBatch]:
        order = np.asarray(pc.array_sort_indices(ids, null_placement="at_start")).astype(np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths, term, doc, count = _counted(data, bounds, wanted)
        cuts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        ends = np.append(cuts[1:], len(term))[: len(cuts)]
        doc = place[doc]
        columns = {
            "block": pa.array([block] * (len(cuts) + 1), pa.int64()),
            "term": pa.array([None, *term[cuts].view(np.int64).tolist()], pa.int64()),
            "n": pa.array([None, *(ends - cuts).tolist()], pa.int64()),
            "docs": pa.array([None, *(doc[x:y].astype(np.uint16).tobytes() for x, y in zip(cuts, ends, strict=True))], pa.binary()),
            "tf": pa.array([None, *(_packed(count[x:y]) for x, y in zip(cuts, ends, strict=True))], pa.binary()),
            "doc_ids": pa.array([ids.take(pa.array(order)).to_pylist(), *[None] * len(cuts)], pa.list_(pa.int64())),
            "lengths": pa.array([lengths[order].astype("<i8").tobytes(), *[None] * len(cuts)], pa.binary()),
        }
        yield pa.RecordBatch.from_pydict(columns)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(texts.mapInArrow(run, _INDEX), "term-index")


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, qtf), stored."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for a, b in groups(bounds, BLOCK_BYTES):
                _, term, row, count = _counted(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], _Wanted(None))
                ids = batch.column(0).slice(a, b - a).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([ids, pa.array(term.view(np.int64)), pa.array(count)], names=["item_id", "term", "qtf"])

    found = items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term long, qtf long")
    return stored(found.groupBy("item_id", "term").agg(F.sum("qtf").alias("qtf")), "item-terms")


def _lengths_factor(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The factor m of documents with `lengths` terms."""
    if len(lengths) and int(lengths.max()) * LENGTH_PERCENT * n_docs >= 1 << 63:
        share = np.array([LENGTH_PERCENT * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
    else:
        share = LENGTH_PERCENT * lengths * n_docs // max(1, n_terms)
    return 100 - LENGTH_PERCENT + share


def _owner(stage: int, last: bool, k: int, n_docs: int, n_terms: int):
    """The work of one owner on one bundle and one block."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        bundle, block = (x.as_py() for x in key)
        lengths = np.frombuffer(left["lengths"][0].as_py(), "<i8")
        m = _lengths_factor(lengths, n_docs, n_terms)
        bounds = left["rest"].combine_chunks().flatten()
        slot, own, bound = (bounds.field(f).to_numpy() for f in ("slot", "stage", "bound"))
        size = int(slot.max()) + 1
        score = np.zeros((size, len(lengths)), np.int64)
        held, docs = (np.frombuffer(left[x][0].as_py() or b"", np.int32) for x in ("slots", "docs"))
        score[held, docs] = np.frombuffer(left["scores"][0].as_py() or b"", np.int64)
        if right.num_rows:
            lists = right["slots"].combine_chunks()
            slots, cuts = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            weights = right["weights"].combine_chunks().flatten().to_numpy()
            for i, (d, f) in enumerate(zip(right["docs"].to_pylist(), right["tf"].to_pylist(), strict=True)):
                at = np.frombuffer(d, np.uint16).astype(np.int64)
                tf = _unpacked(f, len(at))
                gain = GAIN * tf // (TF_SCALE * tf + LENGTH_SCALE * m[at])
                own_slots, own_weights = slots[cuts[i] : cuts[i + 1]], weights[cuts[i] : cuts[i + 1]]
                score[own_slots[:, None], at[None, :]] += own_weights[:, None] * gain[None, :]
        least = np.zeros(size, np.int64)
        if len(lengths) > k:
            least = np.partition(score, len(lengths) - k, axis=1)[:, len(lengths) - k]
        if last:
            best, where = np.nonzero((score > 0) & (score >= least[:, None]))
            found = score[best, where]
            order = np.lexsort((where, -found, best))
            best, where, found = best[order], where[order], found[order]
            first = np.searchsorted(best, best)
            keep = np.arange(len(best)) - first < k
            n = int(keep.sum())
            return pa.table({
                "bundle": pa.array([bundle] * n, pa.int64()), "slot": pa.array(best[keep], pa.int32()), "block": pa.array([block] * n, pa.int64()),
                "place": pa.array(where[keep], pa.int32()), "score": pa.array(found[keep], pa.int64()),
            })
        rest = np.bincount(slot, np.where(own > stage, bound, 0), size).astype(np.int64)
        best, where = np.nonzero((score > 0) & (score + rest[:, None] >= least[:, None]))
        bodies = (best.astype(np.int32), where.astype(np.int32), score[best, where])
        made = [pa.array([x.tobytes()], pa.binary()) for x in bodies]
        return pa.table([left["bundle"], left["block"], left["rest"].cast(_REST), left["lengths"], *made], names=[x.split()[0] for x in _LEFT.split(", ")])

    return run


def top_k(
    docs: DataFrame, items: DataFrame, k: int = 10, bands: tuple[float, ...] = BANDS, few_terms: int = FEW_TERMS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents with a score above 0 of each item.

    Equal scores go by ascending `doc_id`, null first. Null or empty texts have no terms; such documents
    count for nothing and such items have no rows. Rows of `items` that share an id, null included, are one item with
    the terms of all of them. Rows of `docs` that share an id are documents of their own. Without documents or items
    there are no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    pairs = _item_terms(items)
    n_items, n_pairs = pairs.agg(F.count_distinct(F.struct("item_id")), F.count("*")).first()
    bundles = max(1, -(-n_items // BUNDLE_ITEMS), -(-n_pairs // BUNDLE_PAIRS))
    distinct = pairs.select("term").distinct()
    few = distinct.limit(few_terms + 1).toArrow().column(0).to_numpy()
    known = index(docs, few if len(few) <= few_terms else None)
    blocks = known.where("doc_ids is not null").select("block", "doc_ids", "lengths")
    postings = known.where("doc_ids is null").select("block", "term", "n", "docs", "tf")

    # N, L: sums of the blocks, one row each.
    n_docs, n_terms = _totals(blocks)
    frequency = postings.join(distinct, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(WEIGHT_SCALE * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    stage = sum((F.when(F.col("df") > share * n_docs, 1).otherwise(0) for share in bands), F.lit(0))
    place = Window.partitionBy("bundle").orderBy(F.col("item_id").asc_nulls_first())
    slotted = pairs.withColumn("bundle", F.pmod(F.xxhash64("item_id"), F.lit(bundles))).withColumn(
        "slot", (F.dense_rank().over(place) - 1).cast("int")
    )
    weighted = stored(
        slotted.join(frequency, "term")
        .select("bundle", "slot", "item_id", "term", (weight * F.col("qtf")).alias("weight"), stage.cast("int").alias("stage"))
        .where("weight > 0"),
        "item-weights",
    )
    names = weighted.select("bundle", "slot", "item_id").distinct()
    bounds = weighted.groupBy("bundle", "slot", "stage").agg((F.sum("weight") * MOST_GAIN).alias("bound"))
    headers = bounds.groupBy("bundle").agg(F.collect_list(F.struct("slot", "stage", "bound")).alias("rest"))
    wanted = weighted.groupBy("bundle", "term", "stage").agg(F.sort_array(F.collect_list(F.struct("slot", "weight"))).alias("who"))
    wanted = wanted.select("bundle", "term", "stage", F.col("who.slot").alias("slots"), F.col("who.weight").alias("weights"))
    if wanted.count() <= few_terms // 20:
        wanted = F.broadcast(wanted)  # a few MB at most; beyond that a shuffle does the same
    met = postings.join(wanted, "term").select("bundle", "block", "stage", "docs", "tf", "slots", "weights")

    none = F.lit(None).cast("binary")
    state = (
        met.select("bundle", "block").distinct().join(headers, "bundle").join(blocks.select("block", "lengths"), "block")
        .select("bundle", "block", "rest", "lengths", none.alias("slots"), none.alias("docs"), none.alias("scores"))
    )
    for s in range(len(bands) + 1):
        last = s == len(bands)
        own = met.where(F.col("stage") == s).select(
            F.col("bundle").alias("own_bundle"), F.col("block").alias("own_block"), "docs", "tf", "slots", "weights"
        )
        made = "bundle long, slot int, block long, place int, score long" if last else _LEFT
        state = (
            state.groupBy("bundle", "block")
            .cogroup(own.groupBy("own_bundle", "own_block"))
            .applyInArrow(_owner(s, last, k, n_docs, n_terms), made)
        )
    by_score = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"))
    best = state.withColumn("r", F.rank().over(by_score)).where(F.col("r") <= k).drop("r")
    by_id = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return (
        best.join(blocks.select("block", "doc_ids"), "block")
        .select("bundle", "slot", F.expr("doc_ids[place]").alias("doc_id"), "score")
        .withColumn("rank", F.row_number().over(by_id))
        .where(F.col("rank") <= k)
        .join(names, ["bundle", "slot"])
        .select("item_id", "rank", "doc_id", "score")
    )


def _totals(blocks: DataFrame) -> tuple[int, int]:
    """(documents with at least one term, terms of all documents)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = terms = 0
        for batch in batches:
            for body in batch.column(0):
                lengths = np.frombuffer(body.as_py(), "<i8")
                docs, terms = docs + int((lengths > 0).sum()), terms + int(lengths.sum())
        yield pa.RecordBatch.from_pydict({"docs": [docs], "terms": [terms]})

    sums = blocks.select("lengths").mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return sums[0] or 0, sums[1] or 0
