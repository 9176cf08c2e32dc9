"""Reliability metrics over the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.schemas import PARTITION_KEY, RESULT_TYPES


def result_counts(results: DataFrame) -> DataFrame:
    """Current results per class over all pairs, zero where there are none."""
    classes = results.sparkSession.createDataFrame(
        [(k,) for k in RESULT_TYPES], "result_type string"
    )
    counted = results.groupBy("result_type").agg(F.count(F.lit(1)).alias("result_count"))
    # The left side is the five fixed classes.
    return classes.join(counted, "result_type", "left").select(
        "result_type", F.coalesce("result_count", F.lit(0).cast("bigint")).alias("result_count")
    )


def raw_offsets(raw: DataFrame) -> DataFrame:
    return raw.groupBy(*PARTITION_KEY).agg(F.max("kafka_offset").alias("raw_max_offset"))


def checkpoint_lag(raw: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Distance between the newest raw offset and the checkpoint per partition,
    for every partition either side knows.

    Raw events shrink to one row per partition before anything is joined, so
    the outer join meets two small tables and yields the union of positions.
    """
    marks = checkpoints.select(
        *PARTITION_KEY,
        F.col("last_kafka_offset").alias("checkpoint_offset"),
        F.col("updated_at").alias("checkpoint_updated_at"),
    )
    top, mark = F.col("raw_max_offset"), F.col("checkpoint_offset")
    lag = (
        F.when(top.isNull(), F.lit(0))
        .when(mark.isNull(), top + 1)
        .otherwise(F.greatest(top - mark, F.lit(0)))
        .cast("bigint")
    )
    return (
        raw_offsets(raw)
        .join(marks, PARTITION_KEY, "full_outer")
        .select(
            *PARTITION_KEY, "raw_max_offset", "checkpoint_offset", lag.alias("lag"),
            "checkpoint_updated_at",
        )
    )


def total_lag(lag: DataFrame) -> DataFrame:
    return lag.agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))


def reliability_summary(
    raw: DataFrame, dead_letters: DataFrame, ledger: DataFrame, runs: DataFrame, observed_at: Column
) -> DataFrame:
    """One row of table counts with the newest run, also when nothing is stored.

    Each count is a scalar subquery over its own table; the two ledger counts
    merge into one scan.
    """

    def number(df: DataFrame, value: Column) -> Column:
        return df.agg(value.alias("n")).scalar()

    newest = runs.agg(
        F.max_by(F.struct("run_id", "status", "started_at", "completed_at"), "run_id").alias("run")
    ).scalar()
    one = raw.sparkSession.range(1)
    return one.select(
        observed_at.alias("observed_at"),
        number(raw, F.count(F.lit(1))).alias("raw_cdc_event_count"),
        number(dead_letters, F.count(F.lit(1))).alias("dlq_count"),
        number(ledger, F.count(F.lit(1))).alias("current_ledger_record_count"),
        number(ledger, F.count_if("is_deleted")).alias("deleted_record_count"),
        newest.alias("run"),
    ).select(
        "observed_at",
        "raw_cdc_event_count",
        "dlq_count",
        "current_ledger_record_count",
        "deleted_record_count",
        F.col("run.run_id").alias("latest_reconciliation_run_id"),
        F.col("run.status").alias("latest_reconciliation_run_status"),
        F.col("run.started_at").alias("latest_reconciliation_run_started_at"),
        F.col("run.completed_at").alias("latest_reconciliation_run_completed_at"),
    )


@dataclass(frozen=True)
class MetricsBundle:
    summary: DataFrame
    checkpoint_lag: DataFrame


def metrics_bundle(
    raw: DataFrame,
    dead_letters: DataFrame,
    ledger: DataFrame,
    results: DataFrame,
    runs: DataFrame,
    checkpoints: DataFrame,
    observed_at: Column,
    newest_raw: DataFrame | None = None,
) -> MetricsBundle:
    """Summary row with the class counts as a map, plus the lag table, for which
    ``newest_raw`` may stand in for all raw events."""
    classes = result_counts(results).agg(
        F.map_from_entries(F.collect_list(F.struct("result_type", "result_count"))).alias("m")
    )
    summary = reliability_summary(raw, dead_letters, ledger, runs, observed_at)
    return MetricsBundle(
        summary.withColumn("reconciliation_result_counts", classes.scalar()),
        checkpoint_lag(raw if newest_raw is None else newest_raw, checkpoints).orderBy(*PARTITION_KEY),
    )
