"""Tables written to the shared folder of the cluster, which cut lineage and survive lost executors."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyline.session import shared_folder


def stored(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """Write `df` to the shared folder and read it back."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    show_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Rows of an Arrow batch: whole texts go to Python, so far fewer than Spark's own 10,000.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def show_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package from where the driver did.

    On a cluster the package is installed on all machines. Arrow batches of a session that has
    Spark's default size get 2,000 rows, which bounds the memory of the workers.
    """
    root = str(Path(__file__).parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{paths}:{root}".strip(":")
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "2000")
