"""The newest event of each ledger key as streaming state, feeding the guarded upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.apply import canonical_events, latest_by_state
from tallyline.operators.envelope import parse_messages
from tallyline.plans.jobs import Clock, apply_latest, utc_now
from tallyline.plans.state import LedgerState
from tallyline.session import configure, settings
from tallyline.streaming.retry import Backoff


# How the query runs. One row a key outgrows an executor's heap, where Spark keeps state by default; on disk only what a
# batch meets is in memory, and all stores of an executor share one bound.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Nothing reads the number of rows, and keeping it looks up each key once more.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # A message costs far more to parse than to read, so splits by bytes make few, long and uneven tasks.
    "spark.sql.files.maxPartitionBytes": "16m",
}


def start_keyed_latest(
    messages: DataFrame,
    state: LedgerState,
    checkpoint: str,
    consumer_group: str = "ledger-latest",
    on_violation: str = "strict",
    trigger: dict | None = None,
    clock: Clock = utc_now,
    retry: Backoff | None = None,
) -> StreamingQuery:
    """Keep the ledger of ``state`` current from a message stream, without storing raw events.

    The state holds one row for each ledger key, whatever the number of its events; each batch gives
    the rows of the keys it met. They go through the guarded upsert, so late events, repeated ones
    and a batch that is repeated after a failure leave the ledger as it is. There is no watermark: an
    event may be as late as it likes. Malformed messages are skipped; the raw ingestion stores them.
    """
    configure(state.spark)
    # Of the parsed rows nothing depends on the time of reading but stamps that are not kept.
    valid = parse_messages(messages, consumer_group, F.lit(clock())).valid()
    latest = latest_by_state(canonical_events(valid))
    retry = retry or Backoff()

    def store(batch: DataFrame, _batch_id: int) -> None:
        retry.run(lambda: apply_latest(state, batch, on_violation, clock))

    writer = latest.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    with settings(state.spark, SETTINGS):
        return writer.trigger(**(trigger or {"availableNow": True})).start()
