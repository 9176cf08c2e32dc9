"""Incremental maintenance of the current ledger state from raw CDC events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyline.functions import json_text as J
from tallyline.functions.rules import amount_of, record_violation, timestamp_of
from tallyline.schemas import CHECKPOINTS, LEDGER, LEDGER_KEY, PARTITION_KEY

_IDENTITY = ("source_system", "source_record_id", "transaction_id")
_VALUES = ("amount", "currency", "status")
_ORDER = (
    "last_cdc_event_timestamp",
    "last_kafka_topic",
    "last_kafka_partition",
    "last_kafka_offset",
)


def unseen_events(raw: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Raw events beyond their partition's checkpoint (none stored: all).

    The checkpoints are one row per Kafka partition; where they are too many to
    broadcast, adaptive execution splits a partition with many events.
    """
    marks = checkpoints.select(*PARTITION_KEY, "last_kafka_offset")
    joined = raw.join(marks, PARTITION_KEY, "left")
    beyond = F.col("kafka_offset") > F.coalesce("last_kafka_offset", F.lit(-1))
    return joined.where(beyond).drop("last_kafka_offset")


def canonical_events(unseen: DataFrame) -> DataFrame:
    """Eligible events with their canonical ledger fields.

    The record is the key object overlaid by the after image (else the before
    image). Identity members must be present, and amount, currency and status
    too unless the event is a delete; blank or null identifiers drop the event.
    """
    image = f"""case when {J.is_object('after_payload')} then after_payload
                     when {J.is_object('before_payload')} then before_payload end as image"""

    def member(name: str) -> str:
        # SQL NULL is an absent member; a JSON null in the image still wins.
        return f"""coalesce(try_variant_get(image, '$.{name}', 'variant'),
                            try_variant_get(record_key, '$.{name}', 'variant')) as member_{name}"""

    def present(names: tuple[str, ...]) -> str:
        return " and ".join(f"member_{n} is not null" for n in names)

    def text(name: str) -> str:
        return f"cast(member_{name} as string)"

    rows = (
        unseen.selectExpr("*", image)
        .selectExpr("*", *[member(n) for n in (*_IDENTITY, *_VALUES, "updated_at")])
        .selectExpr(
            *unseen.columns,
            "image",
            f"{present(_IDENTITY)} and (operation = 'DELETE' or ({present(_VALUES)})) as eligible",
            *[f"{text(n)} as {n}" for n in _IDENTITY],
            f"{text('amount')} as amount_text",
            f"upper(nullif({text('currency')}, '')) as currency",
            f"upper(nullif({text('status')}, '')) as status",
            f"{text('updated_at')} as updated_at_text",
        )
    )
    # Only what the filter reads is settled, so that unused columns stay prunable.
    settled = J.settle(rows, "eligible", *_IDENTITY)
    named = " and ".join(f"{n} <> ''" for n in _IDENTITY)
    return (
        settled.where(f"eligible and {named}")
        .drop("eligible")
        .withColumn("amount", amount_of(F.col("amount_text")))
    )


def latest_events(canonical: DataFrame) -> DataFrame:
    """The newest event per ledger key, shaped as ledger rows plus ``violation``.

    Catalyst places a rank limit before the shuffle, so a key with very many
    events sends at most one row per map task.
    """
    newest = W.partitionBy(*LEDGER_KEY).orderBy(
        F.desc("event_timestamp"),
        F.desc("kafka_topic"),
        F.desc("kafka_partition"),
        F.desc("kafka_offset"),
    )
    ranked = canonical.withColumn("_rank", F.row_number().over(newest))
    return _shaped(ranked.where(F.col("_rank") == 1).drop("_rank"))


def latest_by_state(canonical: DataFrame) -> DataFrame:
    """What :func:`latest_events` gives, by an aggregate: on a stream its state is one row per key."""
    shaped = _shaped(canonical)
    others = [c for c in shaped.columns if c not in LEDGER_KEY]
    newest = F.max_by(F.struct(*others), F.struct(*_ORDER)).alias("newest")
    return shaped.groupBy(*LEDGER_KEY).agg(newest).select(
        *[F.col(c) if c in LEDGER_KEY else F.col(f"newest.{c}") for c in shaped.columns]
    )


def _shaped(canonical: DataFrame) -> DataFrame:
    """Canonical events as ledger rows plus ``violation``."""
    top = canonical.withColumn("updated_at", timestamp_of(F.col("updated_at_text"))).withColumn(
        "is_deleted", F.col("operation") == "DELETE"
    )
    return top.select(
        *_IDENTITY,
        "amount",
        "currency",
        "status",
        "is_deleted",
        F.coalesce("updated_at", "source_timestamp", "event_timestamp").alias(
            "source_event_timestamp"
        ),
        "source_database",
        "source_schema",
        "source_table",
        F.col("kafka_topic").alias("last_kafka_topic"),
        F.col("kafka_partition").alias("last_kafka_partition"),
        F.col("kafka_offset").alias("last_kafka_offset"),
        F.col("source_lsn").alias("last_source_lsn"),
        F.col("event_timestamp").alias("last_cdc_event_timestamp"),
        F.expr(J.merged_text("record_key", "image")).alias("source_payload"),
        record_violation().alias("violation"),
    )


def storable(latest: DataFrame, as_of: Column) -> DataFrame:
    return (
        latest.where(F.col("violation").isNull())
        .withColumn("refreshed_at", as_of)
        .select(*LEDGER.names)
    )


def rejected(latest: DataFrame, as_of: Column) -> DataFrame:
    """Newest rows that break a ledger constraint, with the constraint."""
    return (
        latest.where(F.col("violation").isNotNull())
        .withColumn("refreshed_at", as_of)
        .select(*LEDGER.names, "violation")
    )


def newest_records(records: DataFrame) -> DataFrame:
    """One ledger row per key out of several layers of rows: the one with the
    latest (event time, topic, partition, offset), of equals the one stored first."""
    newest = W.partitionBy(*LEDGER_KEY).orderBy(
        *[F.desc(c) for c in _ORDER], F.asc("refreshed_at")
    )
    ranked = records.withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def upsert_ledger(ledger: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert new keys; replace a stored row only by one with a later
    (event time, topic, partition, offset).

    Both sides hold each key once, so the join has no hot key; ``incoming``
    arrives from :func:`latest_events` already partitioned and sorted by it.
    """
    old, new = ledger.alias("old"), incoming.alias("new")

    def side(name: str) -> list[Column]:
        return [F.col(f"{name}.{c}") for c in _ORDER]

    matched = old.join(
        new, [F.col(f"old.{c}") == F.col(f"new.{c}") for c in LEDGER_KEY], "full_outer"
    )
    take_new = F.col("old.source_system").isNull() | F.coalesce(
        F.col("new.source_system").isNotNull()
        & (F.struct(*side("old")) < F.struct(*side("new"))),
        F.lit(False),
    )
    return matched.select(
        *[
            F.when(take_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            for c in LEDGER.names
        ]
    )


def partition_progress(unseen: DataFrame) -> DataFrame:
    """Per partition: the highest unseen offset and the number of unseen events,
    eligible or not."""
    return unseen.groupBy(*PARTITION_KEY).agg(
        F.max("kafka_offset").alias("last_kafka_offset"), F.count(F.lit(1)).alias("events")
    )


def advance_checkpoints(checkpoints: DataFrame, progress: DataFrame, as_of: Column) -> DataFrame:
    """Checkpoints raised to the processed offsets, never lowered."""
    stored = checkpoints.select(
        *PARTITION_KEY,
        "last_kafka_offset",
        "updated_at",
        F.lit(None).cast("timestamp").alias("advanced_at"),
    )
    moved = progress.select(
        *PARTITION_KEY,
        "last_kafka_offset",
        F.lit(None).cast("timestamp").alias("updated_at"),
        as_of.alias("advanced_at"),
    )
    merged = stored.unionByName(moved).groupBy(*PARTITION_KEY).agg(
        F.max("last_kafka_offset").alias("last_kafka_offset"),
        F.coalesce(F.max("advanced_at"), F.max("updated_at")).alias("updated_at"),
    )
    return merged.select(*CHECKPOINTS.names)


def processed_count(progress: DataFrame) -> DataFrame:
    return progress.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("processed_count"))


@dataclass(frozen=True)
class Applied:
    ledger: DataFrame
    checkpoints: DataFrame
    rejects: DataFrame
    processed: DataFrame


def apply_events(raw: DataFrame, ledger: DataFrame, checkpoints: DataFrame, as_of: Column) -> Applied:
    """One incremental step as lazy frames; rows that break a constraint are set
    aside in ``rejects`` (the job decides whether that aborts the step)."""
    unseen = unseen_events(raw, checkpoints)
    latest = latest_events(canonical_events(unseen))
    progress = partition_progress(unseen)
    return Applied(
        ledger=upsert_ledger(ledger, storable(latest, as_of)),
        checkpoints=advance_checkpoints(checkpoints, progress, as_of),
        rejects=rejected(latest, as_of),
        processed=processed_count(progress),
    )
