"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample (`sample` vectors with the smallest hash of their id):
principal axes, then rounds that alternate between the nearest binary codes and the rotation that
fits them best, which balances the bits. Every vector gets a code of one bit per axis. Codes are cut into
segments of 16 bits; two vectors are candidates if some segment differs in at most one bit and the
codes in at most `radius` bits. They meet under keys made of a segment without one of its bits, each
pair under the first key that it shares. Candidates are then reranked with the original vectors in
double precision: a link is a cosine of at least `least`, so no link is wrong; the tests measure how
many are found.

Equal vectors are one class, whose members all link; pairs are between classes. Null ids and
unusable vectors (null, zero, another length, null or non-finite components) link with nothing and
each stay a row of their own. Of rows with equal ids and vectors one remains. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.graph import components
from tallyline.llm.storage import stored
from tallyline.llm.vector_codes import matrix, packed

SEGMENT = 16


def learn_rotation(sample: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of iterative quantisation over rows of unit vectors."""
    dims = sample.shape[1]
    if not len(sample):
        return np.zeros(dims), np.eye(dims)
    mean = sample.mean(0)
    _, axes = np.linalg.eigh(np.cov((sample - mean).T, bias=True).reshape(dims, dims))
    flat = (sample - mean) @ axes
    rotation = np.linalg.qr(np.random.default_rng(3).normal(size=(dims, dims)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(flat @ rotation > 0, 1.0, -1.0).T @ flat)
        rotation = right.T @ left.T
    return mean, axes @ rotation


def _units(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    values, good = matrix(column, dims)
    values[~good] = 0
    size = np.linalg.norm(values, axis=1, keepdims=True)
    good &= size[:, 0] > 0
    return np.divide(values, size, out=np.zeros_like(values), where=size > 0), good


def _codes(vectors: DataFrame, dims: int, mean: np.ndarray, projection: np.ndarray) -> DataFrame:
    """(cid, embedding, words): usable vectors with their codes as 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, good = _units(batch.column(1), dims)
            words = packed((units - mean) @ projection > 0).astype(np.int64)
            cuts = pa.array(np.arange(len(words) + 1, dtype=np.int32) * words.shape[1])
            lists = pa.ListArray.from_arrays(cuts, pa.array(words.ravel()))
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [x.filter(keep) for x in (batch.column(0), batch.column(1), lists)], names=["cid", "embedding", "words"]
            )

    return vectors.mapInArrow(run, "cid long, embedding array<float>, words array<long>")


def _candidates(coded: DataFrame, dims: int, radius: int) -> DataFrame:
    """(a, b), a < b: pairs of classes that some segment brings together, each once."""
    segments = -(-dims // SEGMENT)
    part = lambda words, s: F.shiftrightunsigned(F.get(words, F.lit(s // 4)), SEGMENT * (s % 4)).bitwiseAND(0xFFFF)
    keys = []
    for s in range(segments):
        for bit in range(SEGMENT):
            masked = part(F.col("words"), s).bitwiseAND(0xFFFF ^ (1 << bit))
            keys.append(F.struct(F.lit(s * SEGMENT + bit).alias("place"), masked.alias("value")))
    meet = coded.select("cid", "words", F.explode(F.array(*keys)).alias("k")).select("cid", "words", "k.place", "k.value")
    a, b = meet.alias("a"), meet.alias("b")
    apart = F.lit(0)
    for w in range(-(-dims // 64)):
        apart = apart + F.bit_count(F.get(F.col("a.words"), F.lit(w)).bitwiseXOR(F.get(F.col("b.words"), F.lit(w))))
    first = F.lit(None).cast("int")
    for s in reversed(range(segments)):
        differ = part(F.col("a.words"), s).bitwiseXOR(part(F.col("b.words"), s))
        bits = F.bit_count(differ)
        first = F.when(bits == 0, s * SEGMENT).when(bits == 1, s * SEGMENT + F.bit_count(differ - 1)).otherwise(first)
    same = (
        (F.col("a.place") == F.col("b.place"))
        & (F.col("a.value") == F.col("b.value"))
        & (F.col("a.cid") < F.col("b.cid"))
        & (apart <= radius)
        & (F.col("a.place") == first)
    )
    return a.join(b, same).select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b"))


def _linked(pairs: DataFrame, vectors: DataFrame, dims: int, least: float) -> DataFrame:
    """The pairs whose cosine is at least `least`."""
    a = vectors.select(F.col("cid").alias("a"), F.col("embedding").alias("x"))
    b = vectors.select(F.col("cid").alias("b"), F.col("embedding").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _units(batch.column(2), dims)[0], _units(batch.column(3), dims)[0]
            keep = pa.array(np.einsum("ij,ij->i", x, y) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in range(2)], names=["a", "b"])

    full = pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y")
    return full.mapInArrow(run, "a long, b long")


def deduplicate(
    vectors: DataFrame, least: float = 0.95, dims: int = 64, radius: int = 16, sample: int = 8192
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    known = rows.where("vec_id is not null and embedding is not null").distinct()
    classes = stored(
        known.groupBy("embedding").agg(F.min("vec_id").alias("cid"), F.count("*").alias("size")).select("cid", "embedding", "size"),
        "vector-classes",
    )
    drawn = classes.orderBy(F.xxhash64("cid"), "cid").limit(sample).select("cid", "embedding").toArrow()
    units, good = _units(drawn.column(1).combine_chunks(), dims)
    mean, projection = learn_rotation(units[good])
    coded = stored(_codes(classes.select("cid", "embedding"), dims, mean, projection), "vector-codes")
    pairs = _candidates(coded.select("cid", "words"), dims, radius)
    links = stored(_linked(pairs, coded.select("cid", "embedding"), dims, least), "vector-links")
    sizes = classes.select("cid", "size")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partners = (
        ends.join(sizes.select(F.col("cid").alias("b"), "size"), "b").groupBy("a").agg(F.sum("size").alias("partners"))
    )
    found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    of_class = (
        coded.select("cid")
        .join(sizes, "cid")
        .join(partners.withColumnRenamed("a", "cid"), "cid", "left")
        .join(found.withColumnRenamed("id", "cid"), "cid", "left")
        .select(
            "cid",
            (F.col("size") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"),
            F.coalesce("component", "cid").alias("component_id"),
        )
    )
    # A member finds its class by the vector itself.
    member = classes.select(F.col("embedding").alias("e"), F.col("cid").alias("c")).join(of_class, F.col("c") == F.col("cid"))
    return (
        rows.distinct()
        .join(member, F.col("vec_id").isNotNull() & (F.col("embedding") == F.col("e")), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"),
        )
    )
