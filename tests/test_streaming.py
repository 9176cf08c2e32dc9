"""The ingestion stream: exactly once per position, across restarts and replays."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators.apply import canonical_events
from tallyline.operators.envelope import parse_messages
from tallyline.plans import derived as D
from tallyline.plans import jobs
from tallyline.plans.state import LedgerState
from tallyline.schemas import MESSAGES
from tallyline.sources.messages import file_stream, read_messages
from tallyline.streaming import ingestion, latest

# Of 1,000 events those whose id modulo 16 is 1 to 8 are malformed.
DEAD = sum(1 <= n % 16 <= 8 for n in range(1000))


@pytest.fixture(scope="module")
def inbox(spark, sf, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("inbox"))
    messages = D.envelope_messages(D.table(spark, sf, "events"))
    for part in range(3):
        messages.where(F.col("offset") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
    return folder


def run(spark, inbox, state, progress):
    query = ingestion.start_ingestion(file_stream(spark, inbox, 1), state, progress)
    query.awaitTermination()


def test_stream_equals_batch_and_replay_adds_nothing(spark, inbox, tmp_path):
    state = LedgerState(spark, str(tmp_path / "state"))
    run(spark, inbox, state, str(tmp_path / "progress"))
    positions = read_messages(spark, inbox).select("topic", "partition", "offset").distinct().count()
    stored, dead = state.raw_events().count(), state.dead_letters().count()
    assert stored + dead == positions and dead == DEAD
    # The same checkpoint continues; a lost checkpoint replays everything.
    run(spark, inbox, state, str(tmp_path / "progress"))
    run(spark, inbox, state, str(tmp_path / "other-progress"))
    assert (state.raw_events().count(), state.dead_letters().count()) == (stored, dead)


def test_failure_between_the_two_appends(spark, inbox, tmp_path, monkeypatch):
    state = LedgerState(spark, str(tmp_path / "state"))
    insert = LedgerState._insert

    def fail_on_dead_letters(self, rows, table, begun):
        if table == "cdc_dead_letters":
            raise RuntimeError("storage lost")
        insert(self, rows, table, begun)

    with monkeypatch.context() as broken:
        broken.setattr(LedgerState, "_insert", fail_on_dead_letters)
        with pytest.raises(Exception, match="storage lost"):
            run(spark, inbox, state, str(tmp_path / "progress"))
    assert state.raw_events().count() > 0 and state.dead_letters().isEmpty()
    run(spark, inbox, state, str(tmp_path / "progress"))
    assert state.raw_events().count() == 1000 - DEAD and state.dead_letters().count() == DEAD
    repeated = state.raw_events().groupBy("kafka_partition", "kafka_offset").count().where("count > 1")
    assert repeated.isEmpty()


def test_stream_applies_ledger_events(spark, sf, tmp_path):
    events = D.ledger_events(D.table(spark, sf, "orders"))
    messages = D.ledger_messages(events).select(*MESSAGES.names)
    folder = str(tmp_path / "inbox")
    for low, high in ((0, 2000), (2000, 9999)):
        messages.where(f"offset >= {low} and offset < {high}").coalesce(1).write.mode("append").parquet(folder)
    state = LedgerState(spark, str(tmp_path / "state"), buckets=4)
    ingestion.start_ingestion(
        file_stream(spark, folder, 1), state, str(tmp_path / "progress"), apply=True
    ).awaitTermination()
    columns = ["source_system", "source_record_id", "transaction_id", "amount", "currency", "status",
               "is_deleted", "source_event_timestamp", "last_kafka_offset", "last_source_lsn"]
    streamed = state.ledger(state.head()).select(*columns)
    batch = D.ledger_of(events).select(*columns)
    assert streamed.count() == 3000
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert jobs.run_reconciliation(state, "book", "bank") == 1500
    counts = jobs.reliability(state).summary.first()["reconciliation_result_counts"]
    assert counts == {"MATCH": 600, "AMOUNT_MISMATCH": 300, "MISSING_RECORD": 300,
                      "DUPLICATE_RECORD": 150, "STATUS_MISMATCH": 150}


def test_keyed_latest_over_several_batches_and_a_restart(spark, sf, tmp_path):
    """Batches out of order, repeated ones and a restart leave the ledger of the batch job."""
    events = D.ledger_events(D.table(spark, sf, "orders").limit(300))
    messages = D.ledger_messages(events)
    folder = str(tmp_path / "inbox")
    late = F.col("offset") % 5 == 0
    parts = [messages.where(~late & (F.col("offset") < 3000)), messages.where(~late), messages.where(late), messages]
    state = LedgerState(spark, str(tmp_path / "state"), buckets=4)
    for part in parts:  # each start goes on from the state and the files of the one before
        part.coalesce(1).write.mode("append").parquet(folder)
        latest.start_keyed_latest(file_stream(spark, folder, 1), state, str(tmp_path / "progress")).awaitTermination()
    streamed = state.ledger(state.head()).drop("refreshed_at")
    batch = D.ledger_of(events).drop("refreshed_at")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_keyed_state_is_kept_on_disk(spark, inbox, tmp_path):
    """One row a key outgrows a heap; the session's own setting stays as it was."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    state = LedgerState(spark, str(tmp_path / "state"), buckets=4)
    latest.start_keyed_latest(file_stream(spark, inbox), state, str(tmp_path / "progress")).awaitTermination()
    assert spark.conf.get(setting, None) == before
    assert "RocksDBStateStoreProvider" in (tmp_path / "progress" / "offsets" / "0").read_text()


def test_parsing_is_compiled_and_not_interpreted(spark, inbox):
    """The JVM compiles no method of over 8,000 bytes of code."""
    valid = parse_messages(read_messages(spark, inbox)).valid()
    plan = canonical_events(valid)._jdf.queryExecution().executedPlan()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$")
    stages = debug.codegenStringSeq(plan)
    sizes = [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())]
    assert sizes and max(sizes) < 8000
