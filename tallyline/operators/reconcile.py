"""Compare two sides per key and classify every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyline.functions.rules import result_type
from tallyline.schemas import EVIDENCE, RESULT_TYPES, RESULTS, RUNS

PAIR = ["left_source_system", "right_source_system"]
_COUNT_COLUMNS = {kind: f"{kind.lower()}_count" for kind in RESULT_TYPES}


def check_pair(left: str | None, right: str | None) -> None:
    if not left or not right or left == right:
        raise ValueError("Reconciliation requires two distinct, non-empty source systems.")


def active_records(ledger: DataFrame, left: str, right: str) -> DataFrame:
    """Undeleted records of the two systems; a NULL currency matches no key."""
    return ledger.where(
        ~F.col("is_deleted")
        & F.col("source_system").isin(left, right)
        & F.col("currency").isNotNull()
    )


def summarise(sided: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, highest amount and highest status per key and side, classified.

    ``sided`` has the keys plus ``is_left``, ``amount`` and ``status``. One
    shuffle; the aggregate runs before it as well, so a hot key costs each map
    task a single row.
    """
    is_left = F.col("is_left")
    return (
        sided.groupBy(*keys)
        .agg(
            F.count_if(is_left).alias("left_record_count"),
            F.count_if(~is_left).alias("right_record_count"),
            F.max(F.when(is_left, F.col("amount"))).alias("left_amount"),
            F.max(F.when(~is_left, F.col("amount"))).alias("right_amount"),
            F.max(F.when(is_left, F.col("status"))).alias("left_status"),
            F.max(F.when(~is_left, F.col("status"))).alias("right_status"),
        )
        .withColumn("result_type", result_type())
    )


def reconcile(
    ledger: DataFrame, left: str, right: str, run_id: int, as_of: Column
) -> DataFrame:
    """Results of one ordered source pair."""
    check_pair(left, right)
    sided = active_records(ledger, left, right).select(
        "transaction_id", "currency", "amount", "status",
        (F.col("source_system") == left).alias("is_left"),
    )
    return (
        summarise(sided, ["transaction_id", "currency"])
        .withColumn("run_id", F.lit(run_id).cast("bigint"))
        .withColumn("left_source_system", F.lit(left))
        .withColumn("right_source_system", F.lit(right))
        .withColumn("reconciled_at", as_of)
        .select(*RESULTS.names)
    )


def reconcile_frames(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    amount: Column,
    status: Column | None = None,
    right_amount: Column | None = None,
    right_status: Column | None = None,
) -> DataFrame:
    """The same comparison for any two frames that share key columns."""

    def part(df: DataFrame, is_left: bool, value: Column, state: Column | None) -> DataFrame:
        state = F.lit(None).cast("string") if state is None else state
        return df.dropna(subset=keys).select(
            *keys, value.alias("amount"), state.alias("status"), F.lit(is_left).alias("is_left")
        )

    both = part(left, True, amount, status).unionByName(
        part(
            right,
            False,
            amount if right_amount is None else right_amount,
            status if right_status is None else right_status,
        )
    )
    return summarise(both, keys)


def evidence_rows(ledger: DataFrame, left: str, right: str, run_id: int) -> DataFrame:
    """The records behind the results of a pair, one row per record and side.

    Every active record with a currency backs exactly one result, so this is a
    projection: no shuffle, and a hot key never gathers in one place.
    """
    check_pair(left, right)
    return active_records(ledger, left, right).select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.lit(left).alias("left_source_system"),
        F.lit(right).alias("right_source_system"),
        "transaction_id",
        "currency",
        F.when(F.col("source_system") == left, "left").otherwise("right").alias("side"),
        "source_record_id",
        "amount",
        "status",
        "source_event_timestamp",
        F.col("last_kafka_topic").alias("kafka_topic"),
        F.col("last_kafka_partition").alias("kafka_partition"),
        F.col("last_kafka_offset").alias("kafka_offset"),
        F.col("last_source_lsn").alias("source_lsn"),
        "source_payload",
    ).select(*EVIDENCE.names)


def ordered_evidence(evidence: DataFrame) -> DataFrame:
    """Evidence in key, side and record order. The record id is part of the
    sort key, so range partitioning divides a hot key as well."""
    return evidence.orderBy(*PAIR, "transaction_id", "currency", "side", "source_record_id")


KEYS = ["transaction_id", "currency"]


def changed_keys(before: DataFrame, changes: DataFrame) -> DataFrame:
    """The (transaction, currency) whose results may differ after ``changes``: those of the changed
    records, and those that the same records had in the ledger ``before``."""
    records = changes.select("source_system", "source_record_id").distinct()
    old = before.join(records, ["source_system", "source_record_id"], "left_semi")
    return old.select(*KEYS).unionByName(changes.select(*KEYS)).dropna().distinct()


def of_keys(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` with (``left_semi``) or without (``left_anti``) one of the keys. Keys are unique,
    so Catalyst may broadcast them; beyond that a hot key of ``df`` is split."""
    return df.join(keys.select(*KEYS), KEYS, how)


def reconcile_changed(
    ledger: DataFrame, previous: DataFrame, keys: DataFrame, left: str, right: str, run_id: int, as_of: Column
) -> DataFrame:
    """The results of a full run, of which only those of ``keys`` are computed from the ledger; the
    ``previous`` results of the pair stand for all others."""
    fresh = reconcile(of_keys(ledger, keys, "left_semi"), left, right, run_id, as_of)
    kept = of_keys(previous, keys, "left_anti").withColumns(
        {"run_id": F.lit(run_id).cast("bigint"), "reconciled_at": as_of}
    )
    return kept.select(*RESULTS.names).unionByName(fresh)


def evidence_changed(
    ledger: DataFrame, previous: DataFrame, keys: DataFrame, left: str, right: str, run_id: int
) -> DataFrame:
    """The evidence of a full run, with that of ``keys`` alone taken from the ledger."""
    fresh = evidence_rows(of_keys(ledger, keys, "left_semi"), left, right, run_id)
    kept = of_keys(previous, keys, "left_anti").withColumn("run_id", F.lit(run_id).cast("bigint"))
    return kept.select(*EVIDENCE.names).unionByName(fresh)


def class_counts(results: DataFrame, by: list[str]) -> DataFrame:
    """Total and per-class number of results."""
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_result_count"),
        *[F.count_if(F.col("result_type") == k).alias(c) for k, c in _COUNT_COLUMNS.items()],
    )


def run_summary(
    results: DataFrame, left: str, right: str, run_id: int, started_at: Column, completed_at: Column
) -> DataFrame:
    """The run row of a finished reconciliation."""
    return (
        class_counts(results, [])
        .withColumn("run_id", F.lit(run_id).cast("bigint"))
        .withColumn("left_source_system", F.lit(left))
        .withColumn("right_source_system", F.lit(right))
        .withColumn("started_at", started_at)
        .withColumn("completed_at", completed_at)
        .withColumn("status", F.lit("SUCCEEDED"))
        .withColumn("error_message", F.lit(None).cast("string"))
        .select(*RUNS.names)
    )


def replace_pair(results: DataFrame, fresh: DataFrame, left: str, right: str) -> DataFrame:
    """Current results with the pair's rows replaced by ``fresh``."""
    others = results.where(
        (F.col("left_source_system") != left) | (F.col("right_source_system") != right)
    )
    return others.unionByName(fresh)


def backfill_baseline_runs(
    results: DataFrame, first_run_id: int
) -> tuple[DataFrame, DataFrame]:
    """Give results without a run one successful baseline run per source pair.

    Returns the new run rows and the results with every run id filled. A pair's
    run counts all of the pair's results. Ids are consecutive in the order of a
    digest prefix: numbering happens inside 4,096 digest groups, whose sizes (at
    most 4,096 rows) are then summed up, so no task sees all pairs.
    """
    per_pair = (
        _pair_totals(results)
        .where(F.col("unassigned") > 0)
        .withColumn("prefix", F.substring(F.md5(F.concat_ws("|", *PAIR)), 1, 3))
    )
    within = W.partitionBy("prefix").orderBy(*PAIR)
    sizes = per_pair.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(
        "prefix",
        (F.sum("n").over(W.orderBy("prefix").rowsBetween(W.unboundedPreceding, -1))).alias("skip"),
    )
    numbered = (
        per_pair.withColumn("place", F.row_number().over(within))
        .join(before, "prefix")
        .withColumn(
            "run_id",
            (F.lit(first_run_id - 1) + F.coalesce("skip", F.lit(0)) + F.col("place")).cast("bigint"),
        )
        .withColumn("status", F.lit("SUCCEEDED"))
        .withColumn("error_message", F.lit(None).cast("string"))
    )
    runs = numbered.select(*RUNS.names)
    ids = runs.select(*PAIR, F.col("run_id").alias("baseline_run_id"))
    stamped = (
        results.join(ids, PAIR, "left")
        .withColumn("run_id", F.coalesce("run_id", "baseline_run_id"))
        .select(*RESULTS.names)
    )
    return runs, stamped


def _pair_totals(results: DataFrame) -> DataFrame:
    return results.groupBy(*PAIR).agg(
        F.min("reconciled_at").alias("started_at"),
        F.max("reconciled_at").alias("completed_at"),
        F.count(F.lit(1)).alias("total_result_count"),
        *[F.count_if(F.col("result_type") == k).alias(c) for k, c in _COUNT_COLUMNS.items()],
        F.count_if(F.col("run_id").isNull()).alias("unassigned"),
    )
