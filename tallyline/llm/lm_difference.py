"""Cross-entropy difference of documents between two matched n-gram models.

A target model, from the documents of a given set, and a background model, from all documents, have
the same order (bigrams over lower-cased words), the same vocabulary and the same smoothing. The
score of a document is the mean over its words of the target loss minus the background loss:
the lower, the more the document is like the target.

Every word and bigram of every document has its exact count, however rare. With c the counts, N words
and V different words,

    P(w) = (c(w) + 1) / (N + V + 1)        P(w | h) = (c(h, w) + m P(w)) / (c(h) + m)

Documents that follow each other make chunks of about `CHUNK` bytes of text. A task sends each distinct word and
bigram of a chunk (of each part of it, where two tasks read it) once: its sorted 64-bit hashes, as differences, with their counts, packed into one value for each range of hashes. The
owner of a range adds up all chunks and sends to each the whole counts of its n-grams, in the same order and so
without the hashes; these meet the texts again, where the losses are. A frequent n-gram is sent once a chunk, like any
other. Chunks and ranges grow in number, not in size.

A caller may cut the models: words below `word_share` of all count as one unknown word, bigrams below
`bigram_share` as not seen. By default nothing is cut.

Null texts count as empty; a document without words has null losses. Null ids are scored, but are never in the
target; repeated rows count and are scored each. An empty table gives none, an empty target equal chances for
all words. Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storage import stored
from tallyline.llm.text_arrays import LOWER, groups, mixed, range_hashes, text_bytes, word_bounds

COUNTS = "key long, n long, t long"
NUMBERED = "chunk long, row long, doc_id long, target boolean, text string, size long"
# The n-grams of a run of rows of a chunk, from the row `first` on, in a range: `body` holds `n` entries.
# Even ranges are of words, odd ones of bigrams.
SENT = "chunk long, first long, range int, n int, body binary"
# The counts of these n-grams; and, once a range of words, what all of its words add up to.
TOTALS = ("words", "all_n", "all_t", "texts_n", "texts_t")
ANSWERS = SENT + "".join(f", {c} long" for c in TOTALS)
SCORES = "doc_id long, n_words long, target_loss double, background_loss double, difference double"
BROADCAST_IDS = 2_000_000
MERGE = 2_000_000
CHUNK = 6 << 20
ROW = 32  # bytes that a row counts besides its text, so that empty ones fill chunks, too
# Chunks for each range of words and of bigrams: fewer words differ, and few entries in a body pack badly.
PER_RANGE = (8, 2)
# No n-gram is told apart by how frequent it is any more; a test still sets this.
FREQUENT = 1e-6
START, UNKNOWN, _BIGRAM = np.random.default_rng(7).integers(1, 1 << 63, 3, dtype=np.uint64)


@dataclass
class Cuts:
    """What a caller's cuts leave: sorted hashes of known words; sorted kept bigrams and their first words with counts.

    None: nothing is cut.
    """

    known: np.ndarray | None = None
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    before: tuple[np.ndarray, np.ndarray] | None = None

    def words(self, hashes: np.ndarray) -> np.ndarray:
        if self.known is None:
            return hashes
        return np.where(_places(self.known, hashes)[1], hashes, UNKNOWN)


def _places(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each asked key among sorted `keys`, and whether it is there."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return place, keys[place] == asked


def _looked_up(table: tuple[np.ndarray, np.ndarray], asked: np.ndarray) -> np.ndarray:
    """(2, asked): counts of the keys that `table` has, else 0."""
    keys, counts = table
    place, found = _places(keys, asked)
    return counts[:, place] * found if len(keys) else np.zeros((2, len(asked)))


def _contexts(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The word before each word of texts that begin at the words `firsts`."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[_begins(firsts)] = START
    return before


def _begins(firsts: np.ndarray) -> np.ndarray:
    return firsts[:-1][np.diff(firsts) > 0]


def _bigrams(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    return mixed(mixed(_contexts(words, firsts) + _BIGRAM) + words)


def _packed(columns: list[np.ndarray]) -> bytes:
    """Whole numbers by the place of their bytes, so that the zeros of small ones take no room."""
    wide = np.stack([x.astype("<u8") for x in columns])
    planes = wide.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(body: bytes, columns: int, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(body, columns * n * 8, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(columns, 8, n).transpose(0, 2, 1)).view("<u8")[:, :, 0]


def _hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, firsts = word_bounds(data, bounds)
    return range_hashes(LOWER[data], start, end), firsts


def _counted(docs: DataFrame, keys_of) -> DataFrame:
    """Counts of keys, in all documents and in the target ones; `keys_of` gives keys and the text of each."""

    def merged(parts):
        keys = np.concatenate([p[0] for p in parts])
        keys, at = np.unique(keys, return_inverse=True)
        n = np.bincount(at, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)
        t = np.bincount(at, np.concatenate([p[2] for p in parts]), len(keys)).astype(np.int64)
        return keys, n, t

    def rows(part):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in part], names=["key", "n", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            target = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in groups(bounds):
                hashes, firsts = _hashes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                every, text = keys_of(hashes, firsts)
                keys, at = np.unique(every, return_inverse=True)
                of_target = target[a:b][text]
                parts.append((keys, np.bincount(at, minlength=len(keys)), np.bincount(at, of_target, len(keys)).astype(np.int64)))
                held += len(keys)
                if held > MERGE:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > MERGE // 2:
                        yield rows(parts[0])
                        parts, held = [], 0
        if parts:
            yield rows(merged(parts))

    found = docs.select("target", "text").mapInArrow(run, COUNTS)
    return found.groupBy("key").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def _frequent(counts: DataFrame, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys with at least `share` of all, and their counts."""
    counts = stored(counts, "counts")
    least = share * (counts.agg(F.sum("n").alias("n")).first().n or 0)
    kept = counts.where(F.col("n") >= least).toArrow()  # at most 1 / share rows
    keys = kept.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.stack([kept.column(c).to_numpy()[order] for c in ("n", "t")]).astype(np.float64)


def _texts(firsts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def flagged(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """(doc_id, target, text) of all documents."""
    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    ids = stored(ids.withColumn("target", F.lit(True)), "target-ids")
    # Few ids go to all tasks; beyond the limit a shuffle brings them together with the documents.
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(side, "doc_id", "left")
        .select("doc_id", F.coalesce("target", F.lit(False)).alias("target"), "text")
    )


def chunked(docs: DataFrame) -> tuple[DataFrame, int]:
    """All flagged documents with row numbers and the number of their chunk, and about how many chunks there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        for batch in batches:
            row = batch.column(0).to_numpy()
            size = np.diff(text_bytes(batch.column(3))[1]) + ROW
            start = held + np.cumsum(size) - size
            held += int(size.sum())
            chunk = (row >> 33 << 33) + start // CHUNK  # the upper bits are the task's
            columns = [pa.array(chunk), *batch.columns, pa.array(size)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in NUMBERED.split(", ")])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "target", "text")
    # Rows keep their numbers once they are stored, whatever is run again.
    rows = stored(numbered.mapInArrow(run, NUMBERED), "documents")
    return rows, 1 + (rows.agg(F.sum("size").alias("size")).first().size or 0) // CHUNK


def train(docs: DataFrame, word_share: float, bigram_share: float) -> Cuts:
    """What the cuts leave of both models, from all flagged documents."""
    cuts = Cuts()
    if word_share:
        cuts.known = _frequent(_counted(docs, lambda h, firsts: (h.view(np.int64), _texts(firsts))), word_share)[0]
    if bigram_share:
        words_only = Cuts(cuts.known)

        def pairs(hashes, firsts):
            return _bigrams(words_only.words(hashes), firsts).view(np.int64), _texts(firsts)

        cuts.pairs = kept, _ = _frequent(_counted(docs, pairs), bigram_share)

        def contexts(hashes, firsts):
            words = words_only.words(hashes)
            at = np.flatnonzero(_places(kept, _bigrams(words, firsts))[1])
            return _contexts(words, firsts)[at].view(np.int64), _texts(firsts)[at]

        cuts.before = _frequent(_counted(docs, contexts), 0)  # at most as many as kept bigrams
    return cuts


def _all_words(texts: pa.ChunkedArray, cuts: Cuts) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, and the words each text begins at (one entry more)."""
    data, bounds = text_bytes(texts.combine_chunks())
    words, firsts, n = [], [np.zeros(1, np.int64)], 0
    for a, b in groups(bounds, 1 << 20):
        hashes, begin = _hashes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
        words.append(cuts.words(hashes))
        firsts.append(begin[1:] + n)
        n += len(hashes)
    return np.concatenate([np.zeros(0, np.uint64), *words]), np.concatenate(firsts)


def _table(columns: list, schema: str) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.table({name: pa.array(x, types[kind], from_pandas=False) for x, (name, kind) in zip(columns, fields, strict=True)})


def _sent(docs: DataFrame, cuts: Cuts, chunks: int) -> DataFrame:
    """The distinct words and bigrams of each chunk with their counts, by ranges of their hashes.

    A task may read a part of a chunk; each run of following rows is sent for itself.
    """

    def packed(rows: pa.Table) -> pa.Table:
        target = rows["target"].to_numpy().astype(np.int64)
        words, firsts = _all_words(rows["text"], cuts)
        text, has = _texts(firsts), np.flatnonzero(np.diff(firsts))
        out = []

        def send(kind, keys, columns):
            ranges = 1 + chunks // PER_RANGE[kind]
            of = (keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
            cut = np.searchsorted(of, np.arange(ranges + 1, dtype=np.uint64))
            for r in np.flatnonzero(np.diff(cut)).tolist():
                a, b = cut[r], cut[r + 1]
                steps = np.diff(keys[a:b], prepend=np.uint64(0))
                out.append((2 * r + kind, b - a, _packed([steps, *(x[a:b] for x in columns)])))

        keys, at = np.unique(words, return_inverse=True)
        last = at[firsts[1:][has] - 1]  # of each text that has words
        send(
            0,
            keys,
            [
                np.bincount(at, minlength=len(keys)),
                np.bincount(at, target[text], len(keys)),
                np.bincount(last, minlength=len(keys)),
                np.bincount(last, target[has], len(keys)),
            ],
        )
        if cuts.pairs is None:
            keys, at = np.unique(_bigrams(words, firsts), return_inverse=True)
            send(1, keys, [np.bincount(at, minlength=len(keys)), np.bincount(at, target[text], len(keys))])
        own = [[rows[c][0].as_py()] * len(out) for c in ("chunk", "row")]
        return _table([*own, *([x[k] for x in out] for k in range(3))], SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, after = [], None
        for batch in batches:
            chunk, row = (batch.column(k).to_numpy() for k in range(2))
            ends = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(row) != 1)) + 1
            for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(row)], strict=True):
                if a == b:
                    continue
                if held and after != (chunk[a], row[a]):
                    yield from packed(pa.Table.from_batches(held)).to_batches()
                    held = []
                held.append(batch.slice(a, b - a))
                after = (chunk[b - 1], row[b - 1] + 1)
        if held:
            yield from packed(pa.Table.from_batches(held)).to_batches()

    return docs.select("chunk", "row", "target", "text").mapInArrow(run, SENT)


def _answers(sent: DataFrame) -> DataFrame:
    """The counts in all documents of the n-grams that were sent, in the order in which they were."""

    def run(sent: pa.Table) -> pa.Table:
        number = sent["range"][0].as_py()
        columns = 3 if number & 1 else 5
        sizes = sent["n"].to_numpy().astype(np.int64)
        parts = [_unpacked(x.as_py(), columns, n) for x, n in zip(sent["body"], sizes.tolist(), strict=True)]
        keys, at = np.unique(np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts]), return_inverse=True)
        totals = [np.bincount(at, np.concatenate([x[k] for x in parts]), len(keys)).astype(np.int64) for k in range(1, columns)]
        ends = np.cumsum(sizes)
        bodies = [_packed([x[at[b - n : b]] for x in totals]) for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        sums = [0] * len(TOTALS) if number & 1 else [np.count_nonzero(keys != UNKNOWN), *(x.sum() for x in totals)]
        once = [[int(x)] + [0] * (len(sizes) - 1) for x in sums]
        return _table([*(sent[c].to_numpy() for c in ("chunk", "first", "range")), sizes, bodies, *once], ANSWERS)

    return sent.groupBy("range").applyInArrow(run, ANSWERS)


def score(docs: DataFrame, chunks: int, cuts: Cuts, weight: float) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, difference): mean losses of each flagged document."""
    answers = stored(_answers(_sent(docs, cuts, chunks)), "counts")
    total = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS)).first()
    below = np.array([[total.all_n], [total.all_t]], np.float64) + total.words + 1
    starts = np.array([[total.texts_n], [total.texts_t]], np.float64)

    def scored(rows: pa.Table, own: list[tuple]) -> pa.Table:
        words, firsts = _all_words(rows["text"], cuts)

        def counts(keys, kind):
            of = 2 if kind else 4
            found = np.concatenate([np.zeros((of, 0), np.uint64), *(_unpacked(body, of, n) for r, n, body in own if r & 1 == kind)], 1)
            if found.shape[1] != len(keys):
                raise RuntimeError(f"{len(keys)} n-grams have {found.shape[1]} counts")
            return found.astype(np.float64)

        keys, at = np.unique(words, return_inverse=True)
        found = counts(keys, 0)
        chance = ((found[:2] + 1) / below)[:, at]
        if cuts.pairs is None:
            # A word is before another wherever it is not the last; every text with words has a start.
            before = (found[:2] - found[2:])[:, np.roll(at, 1)]
            before[:, _begins(firsts)] = starts
            keys, at = np.unique(_bigrams(words, firsts), return_inverse=True)
            seen = counts(keys, 1)[:, at]
        else:
            before = _looked_up(cuts.before, _contexts(words, firsts))
            seen = _looked_up(cuts.pairs, _bigrams(words, firsts))
        loss = np.log(before + weight) - np.log(seen + weight * chance)
        text, n = _texts(firsts), np.diff(firsts)
        back, goal = (np.bincount(text, x, len(n)) / np.maximum(n, 1) for x in loss)
        means = [pa.array(x, mask=n == 0) for x in (goal, back, goal - back)]
        return _table([rows["doc_id"].combine_chunks(), n, *means], SCORES)

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        own = defaultdict(list)
        for first, *rest in sorted(zip(*(answers[c].to_pylist() for c in ("first", "range", "n", "body")), strict=True)):
            own[first].append(rest)
        firsts = np.array([-1, *own])  # rows before the first have no words
        part = firsts[np.searchsorted(firsts, chunk["row"].to_numpy(), "right") - 1]
        return pa.concat_tables([scored(chunk.filter(pa.array(part == x)), own[x]) for x in np.unique(part).tolist()])

    mine = answers.select("chunk", "first", "range", "n", "body").groupBy("chunk")
    return docs.select("chunk", "row", "doc_id", "text").groupBy("chunk").cogroup(mine).applyInArrow(run, SCORES)


def cross_entropy_difference(
    docs: DataFrame, target_ids: DataFrame, word_share: float = 0.0, bigram_share: float = 0.0, weight: float = 50.0
) -> DataFrame:
    """Scores of all documents against the documents of `target_ids` (doc_id)."""
    both, chunks = chunked(flagged(docs, target_ids))
    return score(both, chunks, train(both, word_share, bigram_share), weight)
