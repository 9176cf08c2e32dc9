"""The symmetric difference of two tables as multisets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digests to compare first; a broadcast of this many rows at most.
BUCKETS = 4096


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*_told(keys)), F.lit(buckets)).cast("int")


def _told(columns: list[str]) -> list[Column]:
    """Columns and where they are null: a null leaves a hash as it is."""
    return [x for c in columns for x in (F.col(c), F.col(c).isNull())]


def digests(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, sum_1, sum_2): sums of two hashes of each row, which do not depend on its order.

    They add up before the shuffle, so each task sends at most ``buckets`` rows.
    """
    told = _told(df.columns)
    rows = df.select(
        _bucket(keys, buckets).alias("bucket"),
        F.xxhash64(*told).cast("decimal(38,0)").alias("h1"),
        F.xxhash64(F.lit("again"), *reversed(told)).cast("decimal(38,0)").alias("h2"),
    )
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum("h1").alias("sum_1"), F.sum("h2").alias("sum_2"))


def differing_buckets(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket): the key buckets in which the two tables differ."""
    a, b = (digests(df, keys, buckets) for df in (left, right))
    same = ["bucket", "rows", "sum_1", "sum_2"]
    return a.unionByName(b).groupBy(*same).agg(F.count(F.lit(1)).alias("sides")).where("sides = 1").select("bucket").distinct()


def symmetric_difference(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The distinct rows of which one table holds more than the other: ``left_surplus`` tells how many
    more the left one holds, negative for the right one.

    Digests of key buckets are compared first, and rows move only from buckets that differ: equal
    tables shuffle nothing else. Nulls are equal to each other. Equal digests of different buckets have
    a chance of about 2**-128. Columns are matched by name; they must be comparable types.
    """
    right = right.select(*left.columns)
    differing = F.broadcast(differing_buckets(left, right, keys, buckets))

    def part(df: DataFrame, weight: int) -> DataFrame:
        near = df.withColumn("difference_bucket", _bucket(keys, buckets))
        named = differing.withColumnRenamed("bucket", "difference_bucket")
        return near.join(named, "difference_bucket", "left_semi").select(*left.columns, F.lit(weight).alias("difference_weight"))

    both = part(left, 1).unionByName(part(right, -1))
    surplus = both.groupBy(*left.columns).agg(F.sum("difference_weight").alias("left_surplus"))
    return surplus.where("left_surplus <> 0")


def except_all(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``left`` without those of ``right``, as often as they are left over."""
    surplus = symmetric_difference(left, right, keys, buckets).where("left_surplus > 0")
    repeated = surplus.withColumn("difference_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "left_surplus")))
    return repeated.select(*left.columns)
