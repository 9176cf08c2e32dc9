"""Structured Streaming ingestion: messages in, raw events and dead letters out."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.envelope import parse_messages
from tallyline.plans.jobs import Clock, process_new_cdc_events, utc_now
from tallyline.plans.state import LedgerState
from tallyline.session import configure
from tallyline.streaming.retry import Backoff


def ingest_batch(
    state: LedgerState, messages: DataFrame, consumer_group: str, clock: Clock = utc_now
) -> None:
    """Store one batch. Both tables take only positions that they lack, so a
    batch that is repeated after a failure completes whatever is missing; jobs
    see its offsets only after both."""
    batch = parse_messages(messages, consumer_group, F.lit(clock()))
    batch.parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        state.store({"raw_cdc_events": batch.valid(), "cdc_dead_letters": batch.dead_letters()})
    finally:
        batch.parsed.unpersist()


def start_ingestion(
    messages: DataFrame,
    state: LedgerState,
    checkpoint: str,
    consumer_group: str = "ledger-ingestion",
    apply: bool = False,
    on_violation: str = "strict",
    trigger: dict | None = None,
    clock: Clock = utc_now,
    retry: Backoff | None = None,
) -> StreamingQuery:
    """Run ingestion on a message stream, optionally applying each batch.

    A batch whose store fails for a passing reason is stored again, by default after
    1 s, doubled up to 30 s, until it succeeds; a lasting error ends the query.

    Spark records a batch's offsets as done only after the tables hold its
    rows. There is no watermark: late events are applied or refused by their
    event time and position alone.
    """
    configure(state.spark)

    retry = retry or Backoff()

    def store(batch: DataFrame, _batch_id: int) -> None:
        retry.run(lambda: ingest_batch(state, batch, consumer_group, clock))
        if apply:
            retry.run(lambda: process_new_cdc_events(state, on_violation, clock))

    writer = messages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
