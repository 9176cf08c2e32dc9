"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storage import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) for each vertex of `edges` (u, v): the smallest vertex that it reaches.

    Alternating stars: every vertex links its larger neighbours, then its smaller ones, to the
    smallest that it knows, until only stars around the smallest vertex of each component are left.
    The smallest neighbour is an aggregate joined back, so a vertex with very many edges is never
    gathered in one group. Each round is a table in the shared folder.
    """
    links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    links = stored(links, "links")
    seen = None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        links = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (now.n, now.h) == seen:
            break
        seen = (now.n, now.h)
    else:
        raise RuntimeError("components did not settle")
    members = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("id"), "component").distinct())
