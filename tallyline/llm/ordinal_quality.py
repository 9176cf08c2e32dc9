"""Quality grades of documents by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(t_k - w.x) with one weight vector for all grades and ordered thresholds
t_0 < t_1 < ...; so a document gets an expected grade, and the probability of each tail, by which
it is kept or not. x are hashed counts of words, word beginnings and word endings over the
whole text, as log(1 + count) weighted by rarity, and four shares that tell repetition and shouting.

The fit uses at most `sample` rated documents, those with the smallest hash of their id; everything
else covers every document. Only features that `least` of them share have a weight.

Null texts count as empty. Rated rows with a null id or grade are not used, of several ratings of
one document the lowest counts. With no rated document, grades and probabilities are null and
every document is kept. Repeated documents are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storage import stored
from tallyline.llm.text_arrays import LOWER, groups, range_hashes, text_bytes, word_bounds

BITS = 18
SHARES = 4
WIDTH = (1 << BITS) + SHARES


@dataclass
class OrdinalModel:
    """Weights by feature and ascending thresholds, one fewer than there are grades."""

    weights: np.ndarray
    thresholds: np.ndarray


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all texts, by row and feature."""
    n = len(bounds) - 1
    start, end, firsts = word_bounds(data, bounds)
    words = np.diff(firsts)
    row = np.repeat(np.arange(n), words)
    lowered = LOWER[data]
    word = range_hashes(lowered, start, end)
    mask = np.uint64((1 << BITS) - 1)
    kinds = [
        word,
        range_hashes(lowered, start, np.minimum(end, start + 4)) + np.uint64(0x5BD1E995),
        range_hashes(lowered, start, np.minimum(end, start + 5)) + np.uint64(0x1B873593),
        range_hashes(lowered, np.maximum(start, end - 3), end) + np.uint64(0xCC9E2D51),
    ]
    keys = np.concatenate([(row << BITS) | ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) & mask).astype(np.int64) for h in kinds])
    keys, count = np.unique(keys, return_counts=True)
    value = np.log1p(count).astype(np.float32)

    several = np.maximum(words, 1)
    same = np.zeros(len(word))
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((word, row))
    again = np.zeros(len(word))
    again[1:] = (word[order][1:] == word[order][:-1]) & (row[order][1:] == row[order][:-1])
    upper = (lowered[start] != data[start]) & (lowered[end - 1] != data[end - 1]) if len(start) else np.zeros(0)
    marks = ~((lowered[end - 1] >= 0x30) & (lowered[end - 1] < 0x3A) | (lowered[end - 1] >= 0x61)) if len(start) else np.zeros(0)
    shares = np.stack(
        [np.bincount(row, x, n) / several for x in (same, again[np.argsort(order)] if len(order) else again, upper, marks)], 1
    )
    rows = np.concatenate([keys >> BITS, np.repeat(np.arange(n), SHARES)])
    ids = np.concatenate([keys & ((1 << BITS) - 1), np.tile(np.arange(1 << BITS, WIDTH), n)])
    values = np.concatenate([value, 4 * shares.ravel().astype(np.float32)])
    order = np.argsort(rows, kind="stable")
    return rows[order], ids[order], values[order]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _residuals(score: np.ndarray, grades: np.ndarray, thresholds: np.ndarray):
    """Slopes of the negative log-likelihood: of each score, and of the thresholds together."""
    bounds = np.concatenate([[-np.inf], thresholds, [np.inf]])
    top = len(thresholds)
    high = np.where(grades == top, 1.0, _sigmoid(bounds[grades + 1] - score))
    low = np.where(grades == 0, 0.0, _sigmoid(bounds[grades] - score))
    inside = np.maximum(high - low, 1e-9)
    slopes = np.bincount(grades + 1, -high * (1 - high) / inside, top + 2)
    slopes += np.bincount(grades, low * (1 - low) / inside, top + 2)
    return 1 - high - low, slopes[1:-1]


def fit(
    rows: list[tuple[int, np.ndarray, np.ndarray]], z: float = 2.0, rounds: int = 150, penalty: float = 0.09
) -> OrdinalModel:
    """Weights and thresholds from (grade, features, values) rows.

    A feature takes part if its score test against thresholds alone reaches `z` deviations. The
    penalised likelihood is then maximised over all rows at once, by Adam with soft thresholds. The
    penalty falls with the root of the number of rows, as the noise of a slope does.
    """
    l1 = penalty / np.sqrt(len(rows))
    grades = np.array([r[0] for r in rows])
    number, top = len(rows), int(grades.max())
    share = np.clip(np.cumsum(np.bincount(grades, minlength=top + 1))[:-1] / number, 1e-3, 1 - 1e-3)
    thresholds = np.log(share / (1 - share))
    slope, _ = _residuals(np.zeros(number), grades, thresholds)
    slope -= slope.mean()
    sums, spread = np.zeros(WIDTH), np.full(WIDTH, 1e-9)
    for r, (_, ids, values) in zip(slope, rows, strict=True):
        sums[ids] += r * values
        spread[ids] += (r * values) ** 2
    used = np.flatnonzero(np.abs(sums) >= z * np.sqrt(spread))
    place = np.full(WIDTH, -1)
    place[used] = np.arange(len(used))
    kept = [place[ids] >= 0 for _, ids, _ in rows]
    ids = np.concatenate([place[r[1][k]] for r, k in zip(rows, kept, strict=True)])
    values = np.concatenate([r[2][k] for r, k in zip(rows, kept, strict=True)]).astype(np.float64)
    owner = np.repeat(np.arange(number), [int(k.sum()) for k in kept])
    # Ordered by construction: the first threshold, then the logarithms of the steps.
    state = np.concatenate([np.zeros(len(used)), thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-2))])
    first, second = np.zeros(len(state)), np.zeros(len(state))
    for step in range(1, rounds + 1):
        weights, steps = state[: len(used)], state[len(used) :]
        thresholds = np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))
        slope, of_bound = _residuals(np.bincount(owner, weights[ids] * values, number), grades, thresholds)
        tail = np.cumsum(of_bound[::-1])[::-1]
        of_steps = np.concatenate([tail[:1], tail[1:] * np.exp(steps[1:])])
        gradient = np.concatenate([np.bincount(ids, slope[owner] * values, len(used)), of_steps]) / number
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        size = 0.05 / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        state = state - size * first / (1 - 0.9**step)
        weights = state[: len(used)]
        weights[:] = np.sign(weights) * np.maximum(np.abs(weights) - np.minimum(size[: len(used)] * l1, 0.02), 0)
    weights = np.zeros(WIDTH, np.float32)
    weights[used] = state[: len(used)]
    steps = state[len(used) :]
    return OrdinalModel(weights, np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])])))


def train(docs: DataFrame, ratings: DataFrame, sample: int = 8_000, least: int = 4) -> OrdinalModel | None:
    """Fit on the texts of at most `sample` ids of `ratings` (doc_id, grade from 0).

    An id that several rows of `docs` share counts once, with the smallest of their texts.
    """
    rated = (
        ratings.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade"))
        .where("doc_id is not null and grade >= 0")
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    out = "doc_id long, grade int, ids binary, vals binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            for a, b in groups(bounds):
                row, ids, values = features(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                cuts = np.searchsorted(row, np.arange(b - a + 1))
                pairs = list(zip(cuts[:-1], cuts[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array([ids[x:y].astype("<i4").tobytes() for x, y in pairs], pa.binary()),
                        pa.array([values[x:y].astype("<f4").tobytes() for x, y in pairs], pa.binary()),
                    ],
                    names=["doc_id", "grade", "ids", "vals"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(rated), "doc_id")
    texts = texts.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    found = stored(texts.select("doc_id", "grade", "text").mapInArrow(run, out), "rated-features")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WIDTH, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_py(), "<i4"), minlength=WIDTH)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    sums = found.select("ids").mapInArrow(shared, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    number = found.count()
    rarity = np.zeros(WIDTH, np.float32)  # 0 also for features that few documents have
    common = sums.where(F.col("n") >= least).toArrow()  # at most WIDTH rows
    rarity[common.column("id").to_numpy()] = np.log(number / common.column("n").to_numpy())
    rarity[1 << BITS :] = 1

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for doc_id, grade, ids, vals in zip(*batch.columns, strict=True):
                ids = np.frombuffer(ids.as_py(), "<i4")
                keep = rarity[ids] > 0
                values = (np.frombuffer(vals.as_py(), "<f4") * rarity[ids])[keep]
                rows.append((doc_id.as_py(), grade.as_py(), ids[keep], values))
        rows.sort(key=lambda r: (r[0], len(r[2]), r[2].tobytes()))
        if rows and max(r[1] for r in rows):
            model = fit([r[1:] for r in rows])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(model.weights * rarity).astype("<f4").tobytes()], pa.binary()),
                    pa.array([model.thresholds.tolist()], pa.list_(pa.float64())),
                ],
                names=["weights", "thresholds"],
            )

    # One task fits the model: it holds at most `sample` documents, whatever the table.
    solved = found.repartition(1).mapInArrow(solve, "weights binary, thresholds array<double>").collect()
    if not solved:
        return None
    return OrdinalModel(np.frombuffer(solved[0].weights, "<f4"), np.array(solved[0].thresholds))


def _above(model: OrdinalModel, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """P(grade > k) for each text and k."""
    row, ids, values = features(data, bounds)
    total = np.bincount(row, model.weights[ids].astype(np.float64) * values, len(bounds) - 1)
    return 1 - _sigmoid(model.thresholds[None, :] - total[:, None])


def score(docs: DataFrame, model: OrdinalModel | None, tail: int, chance: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept) of every document.

    The tail is P(grade >= tail); a document is kept if that is at least `chance`. `tail` is from 1
    to the best grade that was rated.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = "doc_id long, expected_grade double, tail_probability double, kept boolean"
    if model is None:
        return rows.selectExpr("doc_id", "cast(null as double) expected_grade", "cast(null as double) tail_probability", "true kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for a, b in groups(bounds):
                above = _above(model, data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                at = above[:, tail - 1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(above.sum(1)), pa.array(at), pa.array(at >= chance)],
                    names=["doc_id", "expected_grade", "tail_probability", "kept"],
                )

    return rows.mapInArrow(run, out)


def keep(docs: DataFrame, model: OrdinalModel | None, tail: int, chance: float = 0.5) -> DataFrame:
    """The rows of `docs` that `score` keeps, with all their columns."""
    if model is None:
        return docs
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(at))
            for a, b in groups(bounds):
                best = _above(model, data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])[:, tail - 1]
                yield batch.slice(a, b - a).filter(pa.array(best >= chance))

    return docs.mapInArrow(run, docs.schema)


def label_grades(labels: DataFrame) -> DataFrame:
    """Graded ratings of the labels: 0 for low quality, 1 for good but toxic text, 2 for the rest."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))
