"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments of 16 bits, each with a table from segment value to codes. A query
looks up the values at distance 0, 1, 2, ... of each segment in turn. Once radius r is done for
the first s segments, and r - 1 for the rest, every code at Hamming distance up to m * r + s - 1
has been met (m segments); as soon as the k-th verified distance is that small, the answer is complete.

The codes lie in blocks of bounded size with tables of their own, chosen by hash; each block of
queries meets every block of codes, and the best of all blocks are merged. Equal codes are one code with the
smallest k + 1 of its ids, which is all that an answer can use, so a code that very many rows share is small.

Rows with a null id, or an unusable vector (null, another length, null or non-finite components) are
neither queries nor answers. A row does not answer its own query; rows with equal ids count once.
Ties go to the smaller id. Fewer than k other rows give fewer answers; an empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.storage import stored
from tallyline.llm.vector_codes import matrix, packed

SEGMENT = 16


def sign_codes(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, code): a bit for each component, set if it is positive, as little-endian words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, good = matrix(batch.column(1), dims)
            codes = packed(values[good] > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(good)), pa.array([c.tobytes() for c in codes], pa.binary())],
                names=["vec_id", "code"],
            )

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null")
    return rows.mapInArrow(run, "vec_id long, code binary")


@cache
def flips(radius: int) -> np.ndarray:
    """All 16-bit masks with `radius` bits."""
    return np.array([sum(1 << i for i in c) for c in combinations(range(SEGMENT), radius)], np.uint16)


class Tables:
    """Multi-index tables over a block of codes (rows of words)."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.segments = codes.view(np.uint16)
        self.m = self.segments.shape[1]
        self.order, self.first = [], []
        for s in range(self.m):
            value = self.segments[:, s]
            self.order.append(np.argsort(value, kind="stable"))
            self.first.append(np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << SEGMENT))]))

    def search(self, queries: np.ndarray, weight: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance) of every code not beyond the distance of the `need`-th id.

        `weight` is how many ids stand behind each code.
        """
        own = queries.view(np.uint16)
        span = self.m * SEGMENT + 1
        held = np.zeros((len(queries), span), np.int64)
        active = np.arange(len(queries))
        found: list[tuple] = []
        for radius in range(SEGMENT + 1):
            for s in range(self.m):
                values = own[active, s][:, None] ^ flips(radius)[None, :]
                begin, count = self.first[s][values], self.first[s][values.astype(np.int64) + 1]
                count = count - begin
                total = count.sum(1)
                step = max(1, int(len(active) * 4_000_000 / max(1, total.sum())))
                for a in range(0, len(active), step):
                    self._verify(queries, weight, radius, s, active[a : a + step], begin[a : a + step], count[a : a + step], held, found)
                # Complete once `need` ids lie within the distance that is covered by now.
                covered = min(self.m * radius + s, span - 1)
                active = active[held[active, : covered + 1].sum(1) < need]
                if not len(active):
                    break
            if not len(active):
                break
        if not found:
            return (np.zeros(0, np.int64),) * 3
        query, code, distance = (np.concatenate(x) for x in zip(*found, strict=True))
        upto = np.cumsum(held, axis=1)
        last = np.where(upto[:, -1] >= need, (upto < need).sum(1), span)
        keep = distance <= last[query]
        return query[keep], code[keep], distance[keep]

    def _verify(self, queries, weight, radius, s, rows, begin, count, held, found):
        flat = count.ravel()
        upto = np.cumsum(flat)
        total = int(upto[-1]) if len(upto) else 0
        if not total:
            return
        at = np.repeat(begin.ravel() - upto + flat, flat) + np.arange(total)
        code = self.order[s][at]
        query = np.repeat(rows, count.sum(1))
        apart = queries[query] ^ self.codes[code]
        parts = np.bitwise_count(apart.view(np.uint16)).reshape(len(query), self.m)
        # A code counts where it is met first: no earlier segment within this radius, no later one within a smaller.
        new = np.ones(len(query), bool)
        for t in range(self.m):
            if t != s:
                new &= parts[:, t] > radius if t < s else parts[:, t] >= radius
        query, code, distance = query[new], code[new], parts[new].sum(1, dtype=np.int64)
        np.add.at(held, (query, distance), weight[code])
        found.append((query, code, distance))


def _blocks(codes: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Codes with a block number by hash, so that blocks hold about `size` of them."""
    number = max(1, -(-codes.count() // size))
    return codes.withColumn(name, F.pmod(F.xxhash64("code"), F.lit(number)).cast("int")), number


def top_k(
    vectors: DataFrame, every: int = 20, k: int = 10, dims: int = 64, block: int = 1 << 16, queries: int = 1 << 10
) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest of each id divisible by `every`."""
    coded = stored(sign_codes(vectors, dims).distinct(), "codes")
    # One entry for each code, with the k + 1 smallest ids that have it.
    first = Window.partitionBy("code").orderBy("vec_id")
    listed = (
        coded.distinct()
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= k + 1)
        .groupBy("code")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    index, n_index = _blocks(stored(listed, "code-ids"), block, "block")
    asked = coded.where(F.col("vec_id") % every == 0)
    wanted, n_wanted = _blocks(stored(asked.select("code").distinct(), "query-codes"), queries, "part")
    index = index.select("block", F.explode(F.sequence(F.lit(0), F.lit(n_wanted - 1))).alias("part"), "code", "ids")
    wanted = wanted.select(F.explode(F.sequence(F.lit(0), F.lit(n_index - 1))).alias("block"), "part", "code")

    def run(codes: pa.Table, own: pa.Table) -> pa.Table:
        names = ["code", "neighbor_id", "distance"]
        if not codes.num_rows or not own.num_rows:
            return pa.table([pa.array([], pa.binary()), pa.array([], pa.int64()), pa.array([], pa.int32())], names=names)
        words = lambda c: np.frombuffer(b"".join(c.to_pylist()), "<u8").reshape(len(c), -1)
        lists = codes.column("ids").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        asked_codes = own.column("code").to_pylist()
        query, code, distance = Tables(words(codes.column("code"))).search(words(own.column("code")), sizes, k + 1)
        values, starts = lists.flatten().to_numpy(), np.cumsum(sizes) - sizes
        n = sizes[code]
        upto = np.cumsum(n)
        ids = values[np.repeat(starts[code] - upto + n, n) + np.arange(int(upto[-1]) if len(upto) else 0)]
        query, distance = np.repeat(query, n), np.repeat(distance, n)
        order = np.lexsort((ids, distance, query))
        query, ids, distance = query[order], ids[order], distance[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        best = place <= k
        return pa.table(
            [pa.array([asked_codes[i] for i in query[best]], pa.binary()), pa.array(ids[best]), pa.array(distance[best].astype(np.int32))],
            names=names,
        )

    keys = ("block", "part")
    found = (
        index.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(run, "code binary, neighbor_id long, distance int")
    )
    best = Window.partitionBy("code").orderBy("distance", "neighbor_id")
    merged = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    answers = merged.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbor_id"))).alias("best"))
    own = F.slice(F.filter("best", lambda b: b["neighbor_id"] != F.col("query_id")), 1, k)
    return (
        asked.select(F.col("vec_id").alias("query_id"), "code")
        .join(answers, "code")
        .select("query_id", F.posexplode(own).alias("rank", "b"))
        .select("query_id", (F.col("rank") + 1).alias("rank"), "b.neighbor_id", "b.distance")
    )
