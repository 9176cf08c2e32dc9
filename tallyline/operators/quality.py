"""Six data-quality checks over ledger, results and raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.rules import blank, consistent_result, valid_currency
from tallyline.operators.apply import unseen_events
from tallyline.schemas import (
    CHECK_DESCRIPTIONS,
    CHECK_RESULTS,
    STALE_AFTER_SECONDS,
    SUPPORTED_CURRENCIES,
)

_GROUP = ["source_system", "transaction_id", "currency"]
_COUNT = "affected_row_count"


def supported_currencies(spark: SparkSession) -> DataFrame:
    """The seeded currency dimension."""
    return spark.createDataFrame(
        [(c, True) for c in SUPPORTED_CURRENCIES], "currency string, enabled boolean"
    )


def _enabled(currencies: DataFrame) -> DataFrame:
    # Three capital letters allow 26^3 distinct values: a proven broadcast bound.
    usable = currencies.where(F.col("enabled") & valid_currency(F.col("currency")))
    return F.broadcast(usable.select(F.col("currency").alias("enabled_currency")).distinct())


def _active(ledger: DataFrame) -> DataFrame:
    return ledger.where(~F.col("is_deleted"))


def _lacks_field() -> Column:
    return (
        blank(F.col("source_system"))
        | blank(F.col("source_record_id"))
        | blank(F.col("transaction_id"))
        | F.col("amount").isNull()
        | F.col("currency").isNull()
        | blank(F.col("currency"))
        | F.col("status").isNull()
        | blank(F.col("status"))
    )


def _not_positive() -> Column:
    return F.col("amount").isNull() | (F.col("amount") <= 0)


def _bad_currency() -> Column:
    return (
        F.col("currency").isNull()
        | ~valid_currency(F.col("currency"))
        | F.col("enabled_currency").isNull()
    )


def _with_enabled(ledger: DataFrame, currencies: DataFrame) -> DataFrame:
    return ledger.join(
        _enabled(currencies), F.col("currency") == F.col("enabled_currency"), "left"
    )


def duplicate_source_records(ledger: DataFrame) -> DataFrame:
    """Records in groups of several per system, transaction and currency; NULL
    currencies form one group."""
    groups = _active(ledger).groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n"))
    return groups.where(F.col("n") > 1).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(_COUNT))


def missing_required_fields(ledger: DataFrame) -> DataFrame:
    return _active(ledger).where(_lacks_field()).agg(F.count(F.lit(1)).alias(_COUNT))


def non_positive_amounts(ledger: DataFrame) -> DataFrame:
    return _active(ledger).where(_not_positive()).agg(F.count(F.lit(1)).alias(_COUNT))


def unsupported_currency(ledger: DataFrame, currencies: DataFrame) -> DataFrame:
    return (
        _with_enabled(_active(ledger), currencies)
        .where(_bad_currency())
        .agg(F.count(F.lit(1)).alias(_COUNT))
    )


def result_anomalies(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Results of an unsuccessful run, of another pair's run, or at odds with
    their class.

    One run may own most results, so the join first shrinks the results to a
    count per run, pair and inner consistency.
    """
    grouped = results.groupBy(
        "run_id", "left_source_system", "right_source_system"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.coalesce(consistent_result(), F.lit(True))).alias("bad"),
    )
    run = runs.select(
        "run_id",
        F.col("status").alias("run_status"),
        F.col("left_source_system").alias("run_left"),
        F.col("right_source_system").alias("run_right"),
    )
    whole_group = (
        (F.col("run_status") != "SUCCEEDED")
        | (F.col("run_left") != F.col("left_source_system"))
        | (F.col("run_right") != F.col("right_source_system"))
    )
    return grouped.join(run, "run_id").agg(
        F.coalesce(
            F.sum(F.when(whole_group, F.col("n")).otherwise(F.col("bad"))), F.lit(0)
        ).alias(_COUNT)
    )


def stale_events(raw: DataFrame, checkpoints: DataFrame, as_of: Column) -> DataFrame:
    """Unprocessed events ingested more than five minutes before ``as_of``."""
    limit = as_of - F.make_dt_interval(secs=F.lit(STALE_AFTER_SECONDS))
    old = raw.select(
        "kafka_topic", "kafka_partition", "kafka_offset", "ingested_at"
    ).where(F.col("ingested_at") < limit)
    return unseen_events(old, checkpoints).agg(F.count(F.lit(1)).alias(_COUNT))


def ledger_checks(ledger: DataFrame, currencies: DataFrame) -> DataFrame:
    """The four ledger checks in one scan and one shuffle.

    The duplicate check needs rows grouped by system, transaction and currency;
    the other three are summed along in the same groups.
    """
    groups = _active(ledger).groupBy(*_GROUP).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_lacks_field()).alias("lacking"),
        F.count_if(_not_positive()).alias("not_positive"),
    )

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).alias(name)

    totals = _with_enabled(groups, currencies).agg(
        total(F.when(F.col("n") > 1, F.col("n")), "duplicate_source_records"),
        total(F.col("lacking"), "missing_required_transaction_fields"),
        total(F.col("not_positive"), "invalid_non_positive_amounts"),
        total(F.when(_bad_currency(), F.col("n")), "unsupported_invalid_currency"),
    )
    return totals.unpivot([], totals.columns, "check_name", _COUNT)


def run_checks(
    ledger: DataFrame,
    currencies: DataFrame,
    results: DataFrame,
    runs: DataFrame,
    raw: DataFrame,
    checkpoints: DataFrame,
    as_of: Column,
) -> DataFrame:
    """One row per check: PASS when nothing is affected, FAIL otherwise."""
    counts = (
        ledger_checks(ledger, currencies)
        .unionByName(
            result_anomalies(results, runs).withColumn(
                "check_name", F.lit("reconciliation_result_anomalies")
            )
        )
        .unionByName(
            stale_events(raw, checkpoints, as_of).withColumn(
                "check_name", F.lit("stale_unprocessed_cdc_events")
            )
        )
    )
    description = F.lit(None).cast("string")
    for name, text in CHECK_DESCRIPTIONS.items():
        description = F.when(F.col("check_name") == name, text).otherwise(description)
    stale_after = F.when(
        F.col("check_name") == "stale_unprocessed_cdc_events", F.lit(STALE_AFTER_SECONDS)
    )
    return (
        counts.withColumn("executed_at", as_of)
        .withColumn("status", F.when(F.col(_COUNT) == 0, "PASS").otherwise("FAIL"))
        .withColumn(
            "details",
            F.struct(description.alias("description"), stale_after.alias("stale_after_seconds")),
        )
        .select(*CHECK_RESULTS.names)
    )
