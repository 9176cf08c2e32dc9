"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are cut into blocks of `block_words` words (the last one shorter). A source whose target
is q times its size enters with all its blocks floor(q) times and with a part of them once more,
each round in a permutation of its own. The number of blocks that each source gives, its quota, is
then split among the output shards by a binary tree: a node draws how many blocks of each source go
to its left half from the multivariate hypergeometric distribution, so that shards are as mixed as
one random permutation of all blocks would make them, while quotas stay exact. Each shard gets a
range of each source's permuted blocks, disjoint from all others, and shuffles it locally by hash.

Ranks within a source are counted in two steps, over slices of the permutation and within a slice,
so that a source with most of the rows is not in one task. All of it is DataFrame functions; the
driver only holds one row for each source and shard. The draws depend on `seed` and the data alone.

Null texts have size 0, as have empty ones; they are never taken. A null source is a source, the last one.
Documents with the same id are taken each on its own; equal ones are interchangeable. An empty
table gives none. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
SLICES = 512
# The weights of the sources in order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MOST_ROUNDS = 3.0


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST_ROUNDS) -> list[float]:
    """Shares of `total` by weight, none over `most` times its size; the excess goes to the others."""
    out = [0.0] * len(sizes)
    left, open_ = float(total), {i for i, s in enumerate(sizes) if s > 0}
    while open_:
        weight = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / weight >= most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        open_ -= full
    return out


MOST_BALLS = 10**9 - 1


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (columns) for each shard (rows); columns add up to the quotas."""
    rng = np.random.default_rng(seed)

    def split(own: np.ndarray, n: int) -> list[np.ndarray]:
        if n == 1:
            return [own]
        left = n // 2
        take = int(own.sum()) * left // n
        part = np.zeros(len(own), np.int64)
        rest, need = int(own.sum()), take
        for i, have in enumerate(own.tolist()):  # one source after another, given those before
            rest -= have
            part[i] = rng.hypergeometric(have, rest, need) if have and need and rest else min(have, need)
            need -= int(part[i])
        return split(part, left) + split(own - part, n - left)

    # The generator draws from fewer than 10**9 balls. Beyond that a ball stands for several blocks of one
    # source, and the blocks left over, fewer than that for each source, go to shards in turn.
    quotas = quotas.astype(np.int64)
    each = int(quotas.sum()) // MOST_BALLS + 1
    out = np.array(split(quotas // each, shards)) * each
    for i, left in enumerate((quotas % each).tolist()):
        out[(np.arange(shards) + i) % shards, i] += left // shards + (np.arange(shards) < left % shards)
    return out


def plan_sources(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_ROUNDS) -> list[dict]:
    """Per source, in code point order and null last: size, blocks and target words."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.sum("blocks").alias("blocks")).collect()
    # One row for each source: the configuration of the mixture.
    rows = sorted(rows, key=lambda r: (r.source is None, (r.source or "").encode("utf-8", "surrogatepass")))
    sizes = [r.size for r in rows]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], sum(sizes), most)
    return [
        {"place": i, "source": r.source, "source_size": r.size, "blocks": r.blocks, "target": t}
        for i, (r, t) in enumerate(zip(rows, goal, strict=True))
    ]


def sized_documents(docs: DataFrame, block_words: int, *keep: str) -> DataFrame:
    """(doc_id, source, size, blocks) of each document, and the columns of `keep`."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words_of(F.col("text")).alias("size"),
        *keep,
    )
    return rows.withColumn("blocks", F.ceil(F.col("size") / block_words).cast("long"))


def draw(sized: DataFrame, sources: list[dict], block_words: int, shards: int, seed: int) -> DataFrame:
    """The blocks of the mix: (shard, place, source, doc_id, tie, block, round, words).

    `sized` has (doc_id, tie, source, size, blocks), `tie` telling documents apart.
    """
    spark = sized.sparkSession
    blocks = (
        sized.where("blocks > 0")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("words", F.least(F.lit(block_words).cast("long"), F.col("size") - F.col("block") * block_words))
    )
    names = "place int, source string, round int, whole long, need double"
    rounds = []
    for s in sources:
        whole = s["source_size"]
        for k in range(math.ceil(s["target"] / whole) if whole else 0):
            rounds.append((s["place"], s["source"], k, s["blocks"], min(float(whole), s["target"] - k * whole)))
    if not rounds:
        rounds = [(0, None, 0, 0, 0.0)]
    wanted = spark.createDataFrame(rounds, names)  # at most MOST_ROUNDS rows for each source
    key = F.xxhash64(F.lit(seed), "round", "doc_id", "tie", "block")
    entered = (
        blocks.alias("b")
        .join(F.broadcast(wanted).alias("w"), F.col("b.source").eqNullSafe(F.col("w.source")))
        .select("place", "b.source", "round", "doc_id", "tie", "block", "words", "need")
        .withColumn("key", key)
        .withColumn("slice", F.pmod(F.shiftrightunsigned("key", 20), F.lit(SLICES)).cast("int"))
    )
    # Words and blocks before each slice: SLICES rows for each source and round.
    before = Window.partitionBy("place", "round").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        entered.groupBy("place", "round", "slice")
        .agg(F.sum("words").alias("words"), F.count("*").alias("n"))
        .select(
            "place",
            "round",
            "slice",
            F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_before"),
        )
    )
    within = Window.partitionBy("place", "round", "slice").orderBy("key", "doc_id", "tie", "block")
    ranked = (
        entered.join(slices, ["place", "round", "slice"])
        .withColumn("upto", F.col("words_before") + F.sum("words").over(within.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("upto", F.coalesce("upto", "words_before"))
    )
    # A block is taken if less than half of it lies beyond the words that the round needs.
    taken = stored(
        ranked.where(F.col("upto") + F.col("words") / 2 <= F.col("need")).select(
            "place", "source", "round", "slice", "key", "doc_id", "tie", "block", "words"
        ),
        "mix-blocks",
    )
    counts = taken.groupBy("place").agg(F.count("*").alias("n")).collect()  # one row for each source
    quotas = np.zeros(max([s["place"] for s in sources], default=0) + 1, np.int64)
    for r in counts:
        quotas[r.place] = r.n
    cuts = np.cumsum(split_quotas(quotas, shards, seed), axis=0)
    ends = spark.createDataFrame(
        [(i, cuts[:, i].tolist()) for i in range(len(quotas))], "place int, cuts array<long>"
    )  # one row for each source
    earlier = Window.partitionBy("place").orderBy("round", "slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        taken.groupBy("place", "round", "slice")
        .agg(F.count("*").alias("n"))
        .select("place", "round", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    )
    rank = (F.col("first") + F.row_number().over(within) - 1).alias("rank")
    placed = (
        taken.join(firsts, ["place", "round", "slice"])
        .select("place", "source", "round", "key", "doc_id", "tie", "block", "words", rank)
        .join(F.broadcast(ends), "place")
    )
    shard = F.size(F.filter("cuts", lambda c: c <= F.col("rank")))
    return placed.select(
        shard.alias("shard"),
        F.xxhash64(F.lit(seed + 1), "key", "rank").alias("place"),
        "source",
        "doc_id",
        "tie",
        "block",
        "round",
        "words",
    )


def _tie() -> Column:
    """A hash that tells documents apart; equal ones may share it."""
    return F.xxhash64("doc_id", "source", "text", F.isnull("doc_id"), F.isnull("source")).alias("tie")


def mix(docs: DataFrame, block_words: int = 256, shards: int = 16, seed: int = 11) -> tuple[DataFrame, DataFrame, list[dict]]:
    """(sized documents, drawn blocks, sources) of a mix of `docs`; see `draw`.

    In shard order, sorted by `place`, the drawn blocks are the mixed corpus.
    """
    sized = stored(
        sized_documents(docs, block_words, "text").select("doc_id", "source", "size", "blocks", _tie()), "mix-sizes"
    )
    sources = plan_sources(sized)
    return sized, draw(sized, sources, block_words, shards, seed), sources


def taken_words(sized: DataFrame, drawn: DataFrame, sources: list[dict]) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    spark = sized.sparkSession
    known = [(s["source"], s["source_size"], s["target"]) for s in sources] or [(None, 0, 0.0)]
    of_source = spark.createDataFrame(known, "source string, source_size long, target double")
    # Documents equal in everything share the words taken from them evenly.
    took = drawn.groupBy("tie").agg(F.sum("words").alias("words"))
    copies = sized.groupBy("tie").agg(F.count("*").alias("copies"))
    rows = sized.join(copies, "tie").join(took, "tie", "left")
    each = F.coalesce(F.col("words"), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("tie").orderBy("size"))
    part = F.floor(each / F.col("copies")) + F.when(nth <= each % F.col("copies"), 1).otherwise(0)
    rows = rows.select("doc_id", "source", "size", part.cast("long").alias("taken"))
    return (
        rows.alias("r")
        .join(F.broadcast(of_source).alias("o"), F.col("r.source").eqNullSafe(F.col("o.source")))
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def mixed_documents(docs: DataFrame, shards: int = 16, seed: int = 11) -> DataFrame:
    """A mix of whole documents with the columns of `docs`, one row each time a document is taken.

    Shard by shard, each shuffled by hash; ranges of this order, not shards, are the tasks.
    """
    _, drawn, _ = mix(docs, 1 << 40, shards, seed)
    own = Window.partitionBy("tie").orderBy("row.doc_id")
    texts = docs.select(_tie(), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    texts = texts.withColumn("copy", F.row_number().over(own)).where("copy = 1").drop("copy")
    rows = drawn.select("tie", "shard", "place").join(texts, "tie")
    ranged = rows.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    return ranged.select("row.*")
