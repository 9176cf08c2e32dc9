"""Registered queries: each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators import apply as A
from tallyline.operators import dedup, difference, envelope, intervals, investigate, metrics, quality
from tallyline.operators import reconcile as R
from tallyline.plans import derived as D
from tallyline.plans import jobs
from tallyline.plans.state import LedgerState
from tallyline.session import configure, shared_folder
from tallyline.sources.messages import file_stream, read_event_lines
from tallyline.streaming.ingestion import start_ingestion
from tallyline.streaming.latest import start_keyed_latest
from tallyline.streaming.retry import Backoff

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def now():
    return D.instant(D.EPOCH)


def portable(df: DataFrame) -> DataFrame:
    """Plain column types for comparing engines: whole numbers as bigint,
    decimals as text, instants as epoch microseconds."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return portable(build(spark, sf_dir))

    _QUERIES[build.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _orders(spark, sf_dir):
    return D.table(spark, sf_dir, "orders")


def _parsed(spark, sf_dir):
    messages = D.envelope_messages(D.table(spark, sf_dir, "events"))
    return envelope.parse_messages(messages, as_of=now())


# -- messages ----------------------------------------------------------------


def _event_columns(valid: DataFrame) -> DataFrame:
    image = F.coalesce(
        F.try_variant_get("after_payload", "$.marker", "string"),
        F.try_variant_get("before_payload", "$.marker", "string"),
    )
    return valid.select(
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "operation",
        "source_database", "source_schema", "source_table", "event_timestamp",
        "source_timestamp", "source_lsn", "source_tx_id",
        F.try_variant_get("transaction_metadata", "$.id", "string").alias("transaction"),
        F.try_variant_get("record_key", "$.marker", "string").alias("key_marker"),
        image.alias("marker"),
    )


@query
def cdc_parse_valid(spark, sf_dir):
    return _event_columns(_parsed(spark, sf_dir).valid())


@query
def cdc_dlq_split(spark, sf_dir):
    dead = dedup.first_per_position(_parsed(spark, sf_dir).dead_letters())
    return dead.select(
        "kafka_topic", "kafka_partition", "kafka_offset", "error_class", "failure_reason",
        F.col("record_key").cast("string").alias("record_key"),
        F.col("record_value").cast("string").alias("record_value"),
    )


@query
def cdc_dlq_headers(spark, sf_dir):
    dead = _parsed(spark, sf_dir).dead_letters()
    return dead.select(
        "kafka_topic", "kafka_partition", "kafka_offset", F.inline("record_headers")
    )


@query
def cdc_dedup_positions(spark, sf_dir):
    valid = _parsed(spark, sf_dir).valid()
    captured = valid.where(F.col("operation") == "SNAPSHOT")
    return dedup.absent_rows(valid, captured).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "operation", "source_tx_id"
    )


@query
def marker_exactly_once(spark, sf_dir):
    folder = shared_folder(spark, "event-lines")
    D.envelope_lines(D.table(spark, sf_dir, "events")).select("line").write.text(folder)
    return envelope.marker_counts(read_event_lines(spark, folder))


@query
def stream_ingest(spark, sf_dir):
    events = D.table(spark, sf_dir, "events")
    # A stream takes no single file as its path; the pattern matches the table
    # whether it is one file or a folder of files.
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")
    folder = shared_folder(spark, "ingest")
    state = LedgerState(spark, f"{folder}/state")
    running = start_ingestion(D.envelope_messages(stream), state, f"{folder}/progress")
    running.awaitTermination()
    stored = _event_columns(state.raw_events()).select(
        "kafka_topic", "kafka_partition", "kafka_offset", F.col("operation").alias("outcome")
    )
    dead = state.dead_letters().select(
        "kafka_topic", "kafka_partition", "kafka_offset", F.col("failure_reason").alias("outcome")
    )
    return stored.unionByName(dead)


class _Flaky(LedgerState):
    """A state whose storage fails twice for a passing reason, before and between its two inserts."""

    failures = ["raw_cdc_events", "cdc_dead_letters"]

    def _insert(self, rows, table, begun):
        if table in self.failures:
            self.failures = [t for t in self.failures if t != table]
            raise OSError(f"no answer while writing {table}")
        super()._insert(rows, table, begun)


@query
def stream_ingest_retry(spark, sf_dir):
    """The stream of all events over a storage that fails twice: each position once."""
    events = D.table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")
    folder = shared_folder(spark, "ingest")
    state = _Flaky(spark, f"{folder}/state")
    retry = Backoff(first=0.1, most=0.2)
    start_ingestion(D.envelope_messages(stream), state, f"{folder}/progress", retry=retry).awaitTermination()
    rows = [df.select("kafka_topic", "kafka_partition", "kafka_offset") for df in (state.raw_events(), state.dead_letters())]
    return rows[0].withColumn("stored", F.lit("event")).unionByName(rows[1].withColumn("stored", F.lit("dead letter")))


def _stored_valid(spark, sf_dir) -> LedgerState:
    state = LedgerState(spark, shared_folder(spark, "state"))
    state.store({"raw_cdc_events": _parsed(spark, sf_dir).valid()}, staged=True)
    return state


@query
def offsets_stored_ranges(spark, sf_dir):
    """The offsets of all valid events as the ranges that storing them leaves."""
    return _stored_valid(spark, sf_dir).stored_ranges()


@query
def offsets_skipped(spark, sf_dir):
    """The offsets between those of valid events, which nothing was stored for."""
    return intervals.gaps(_stored_valid(spark, sf_dir).stored_ranges())


# -- applying events ---------------------------------------------------------


@query
def cdc_unseen_events(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    unseen = A.unseen_events(D.ledger_events(orders), D.half_way_checkpoints(orders))
    return unseen.select(
        "kafka_topic", "kafka_partition", "kafka_offset", "operation", "event_timestamp"
    )


@query
def cdc_canonical(spark, sf_dir):
    rows = A.canonical_events(D.ledger_events(_orders(spark, sf_dir), defective=True))
    return rows.select(
        "kafka_topic", "kafka_partition", "kafka_offset", "operation", "source_system",
        "source_record_id", "transaction_id", "amount", "currency", "status",
    )


def _ledger_columns(ledger: DataFrame) -> DataFrame:
    payload = F.parse_json("source_payload")
    return ledger.withColumns(
        {
            "payload_status": F.try_variant_get(payload, "$.status", "string"),
            "payload_record": F.try_variant_get(payload, "$.source_record_id", "string"),
        }
    ).drop("source_payload", "refreshed_at")


@query
def ledger_current_latest(spark, sf_dir):
    return _ledger_columns(D.ledger(_orders(spark, sf_dir)))


@query
def ledger_current_upsert(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    raw, marks = D.ledger_events(orders), D.half_way_checkpoints(orders)
    stored = D.ledger_of(D.seen_events(raw, marks))
    return _ledger_columns(A.apply_events(raw, stored, marks, now()).ledger)


@query
def ledger_current_layers(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    raw, marks = D.ledger_events(orders), D.half_way_checkpoints(orders)
    stored = D.ledger_of(D.seen_events(raw, marks))
    changed = D.ledger_of(A.unseen_events(raw, marks))
    return _ledger_columns(A.newest_records(stored.unionByName(changed)))


@query
def ledger_bucketed_upsert(spark, sf_dir):
    """Half of the events as a bucketed ledger, the others as a layer of changes on it."""
    orders = _orders(spark, sf_dir)
    raw = D.ledger_events(orders)
    state = LedgerState(spark, shared_folder(spark, "state"), buckets=16)
    for part in (D.seen_events(raw, D.half_way_checkpoints(orders)), raw):
        state.store({"raw_cdc_events": part})
        jobs.process_new_cdc_events(state)
    return _ledger_columns(state.ledger(state.head()))


@query
def ledger_stream_latest(spark, sf_dir):
    """The ledger from streaming state: half of the events, then, after a restart, all of them."""
    orders = _orders(spark, sf_dir)
    messages = D.ledger_messages(D.ledger_events(orders))
    folder = shared_folder(spark, "latest")
    state = LedgerState(spark, f"{folder}/state", buckets=16)
    mark = D.half_way_checkpoints(orders).agg(F.max("last_kafka_offset")).scalar()
    for part in (messages.where(F.col("offset") <= mark), messages):
        part.write.mode("append").parquet(f"{folder}/inbox")
        start_keyed_latest(file_stream(spark, f"{folder}/inbox"), state, f"{folder}/progress").awaitTermination()
    return _ledger_columns(state.ledger(state.head()))


@query
def cdc_checkpoints_advance(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    marks = D.half_way_checkpoints(orders)
    unseen = A.unseen_events(D.ledger_events(orders, defective=True), marks)
    return A.advance_checkpoints(marks, A.partition_progress(unseen), D.instant(D.EPOCH + 60))


@query
def cdc_apply_summary(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    raw = D.ledger_events(orders, defective=True)
    unseen = A.unseen_events(raw, D.half_way_checkpoints(orders))
    return A.processed_count(A.partition_progress(unseen))


@query
def cdc_rejects(spark, sf_dir):
    latest = A.latest_events(
        A.canonical_events(D.ledger_events(_orders(spark, sf_dir), defective=True))
    )
    return A.rejected(latest, now()).select(
        "source_system", "source_record_id", "is_deleted", "last_kafka_offset", "violation"
    )


# -- reconciliation ----------------------------------------------------------


def _result_columns(results: DataFrame) -> DataFrame:
    return results.drop("reconciled_at")


@query
def reconcile_results(spark, sf_dir):
    return _result_columns(D.results(_orders(spark, sf_dir)))


@query
def reconcile_run_summary(spark, sf_dir):
    results = D.results(_orders(spark, sf_dir), run_id=7)
    return R.run_summary(results, "book", "bank", 7, now(), D.instant(D.EPOCH + 5))


@query
def reconcile_evidence(spark, sf_dir):
    evidence = R.evidence_rows(D.ledger(_orders(spark, sf_dir)), "book", "bank", 1)
    payload = F.parse_json("source_payload")
    return evidence.withColumn(
        "payload_currency", F.try_variant_get(payload, "$.currency", "string")
    ).drop("source_payload")


@query
def reconcile_evidence_hot(spark, sf_dir):
    """Every record behind ten transactions that hold all line items, in order."""
    lines = D.table(spark, sf_dir, "lineitem")
    none = F.lit(None).cast("string")
    ledger = lines.select(
        F.when(F.col("l_linenumber") % 2 == 1, "book").otherwise("bank").alias("source_system"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_record_id"),
        F.concat(F.lit("tx-"), F.col("l_suppkey") % 10).alias("transaction_id"),
        F.lit("USD").alias("currency"),
        F.col("l_extendedprice").cast("decimal(20,4)").alias("amount"),
        F.col("l_linestatus").alias("status"),
        F.lit(False).alias("is_deleted"),
        now().alias("source_event_timestamp"),
        F.lit("lines").alias("last_kafka_topic"),
        F.lit(0).alias("last_kafka_partition"),
        F.col("l_orderkey").cast("bigint").alias("last_kafka_offset"),
        none.alias("last_source_lsn"),
        none.alias("source_payload"),
    )
    evidence = R.ordered_evidence(R.evidence_rows(ledger, "book", "bank", 1))
    return evidence.select("transaction_id", "currency", "side", "source_record_id", "amount", "status")


@query
def results_with_evidence(spark, sf_dir):
    ledger = D.ledger(_orders(spark, sf_dir))
    evidence = R.evidence_rows(ledger, "book", "bank", 1).where("source_record_id like '%-b'")
    shown = investigate.with_any_evidence(R.reconcile(ledger, "book", "bank", 1, now()), evidence)
    return shown.select("transaction_id", "currency", "result_type")


@query
def reconcile_orders_lineitem(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").cast("decimal(20,4)").alias("amount")
    )
    lines = D.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_extendedprice").cast("decimal(20,4)").alias("amount"),
    )
    compared = R.reconcile_frames(orders, lines, ["order_key"], F.col("amount"))
    return compared.drop("left_status", "right_status")


@query
def reconcile_hot_keys(spark, sf_dir):
    """Line items against themselves by supplier decile and return flag: ten
    transactions hold all rows."""
    lines = D.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("tx-"), F.col("l_suppkey") % 10).alias("transaction_id"),
        F.col("l_returnflag").alias("currency"),
        F.col("l_extendedprice").cast("decimal(20,4)").alias("amount"),
        F.col("l_linestatus").alias("status"),
        "l_linenumber",
    )
    # The first lines of the orders form the left side.
    first = F.col("l_linenumber") == 1
    return R.reconcile_frames(
        lines.where(first), lines.where(~first), ["transaction_id", "currency"],
        F.col("amount"), F.col("status"),
    )


@query
def result_replace(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    raw = D.ledger_events(orders)
    earlier = D.ledger_of(D.seen_events(raw, D.half_way_checkpoints(orders)))
    current = R.reconcile(earlier, "book", "bank", 1, now()).unionByName(
        R.reconcile(earlier, "bank", "book", 2, now())
    )
    fresh = R.reconcile(D.ledger(orders), "book", "bank", 3, now())
    return _result_columns(R.replace_pair(current, fresh, "book", "bank"))


@query
def state_reconciliation(spark, sf_dir):
    """The jobs over stored tables: append and apply in two steps, the second of
    which repeats the first one's events, then reconcile."""
    orders = _orders(spark, sf_dir)
    raw = D.ledger_events(orders)
    state = LedgerState(spark, shared_folder(spark, "state"), buckets=16)
    for part in (D.seen_events(raw, D.half_way_checkpoints(orders)), raw):
        state.store({"raw_cdc_events": part})
        jobs.process_new_cdc_events(state)
    jobs.run_reconciliation(state, "book", "bank")
    return _result_columns(state.results(state.head()))


@query
def reconcile_changed_keys(spark, sf_dir):
    """A run over half of the events, then one of the changed transactions alone after the rest."""
    orders = _orders(spark, sf_dir)
    raw = D.ledger_events(orders)
    state = LedgerState(spark, shared_folder(spark, "state"), buckets=16)
    for part in (D.seen_events(raw, D.half_way_checkpoints(orders)), raw):
        state.store({"raw_cdc_events": part})
        jobs.process_new_cdc_events(state)
        jobs.run_reconciliation(state, "book", "bank", changed_only=True)
    return _result_columns(state.results(state.head()))


class _NoSpace(LedgerState):
    """A state that has no room for a second run's evidence."""

    def write(self, df, table, commit, by=None):
        if table == "result_evidence" and self.head().last_run_id:
            raise OSError("no space left")
        super().write(df, table, commit, by)


@query
def state_failed_run(spark, sf_dir):
    """The run history of a run that succeeds and one that fails, with the results that stay."""
    state = _NoSpace(spark, shared_folder(spark, "state"), buckets=16)
    jobs.put_ledger(state, D.ledger(_orders(spark, sf_dir)))
    jobs.run_reconciliation(state, "book", "bank")
    jobs.run_reconciliation(state, "book", "bank")
    head = state.head()
    kept = state.results(head)
    runs = state.appended("runs", head).select("run_id", "status", "total_result_count", "match_count", "error_message")
    return runs.withColumns(
        {
            "results_kept": kept.agg(F.count(F.lit(1))).scalar(),
            "results_of_run": kept.agg(F.max("run_id")).scalar(),
        }
    )


@query
def state_baseline_backfill(spark, sf_dir):
    """Stored results without a run, given baseline runs by the job, which is then repeated."""
    state = LedgerState(spark, shared_folder(spark, "state"))
    jobs.put_results(state, _unassigned_results(_orders(spark, sf_dir)))
    jobs.backfill_baseline_runs(state)
    jobs.backfill_baseline_runs(state)
    head = state.head()
    runs = state.appended("runs", head).select("run_id", "total_result_count", F.lit(None).cast("string").alias("transaction_id"))
    of_run = state.results(head).select("run_id", F.lit(None).cast("bigint").alias("total_result_count"), "transaction_id")
    return runs.unionByName(of_run)


@query
def state_quality_history(spark, sf_dir):
    """Checks of a stored ledger with and without a currency list of its own: the
    stored history, paged."""
    orders = _orders(spark, sf_dir)
    state = LedgerState(spark, shared_folder(spark, "state"), buckets=16)
    jobs.put_ledger(state, D.ledger(orders))
    at = lambda s: lambda: datetime.fromtimestamp(D.EPOCH + s, timezone.utc)
    jobs.run_checks(state, clock=at(0))
    rows = [("USD", True), ("EUR", True), ("JPY", True), ("GBP", False)]
    jobs.put_currencies(state, spark.createDataFrame(rows, "currency string, enabled boolean"))
    jobs.run_checks(state, clock=at(60))
    page = investigate.quality_page(state.appended("check_results", state.head()), limit=200)
    return _with_total(page).drop("details")


@query
def state_quarantine(spark, sf_dir):
    """Newest events that break a constraint, set aside while the rest is applied."""
    raw = D.ledger_events(_orders(spark, sf_dir), defective=True)
    state = LedgerState(spark, shared_folder(spark, "state"), buckets=16)
    state.store({"raw_cdc_events": raw})
    jobs.process_new_cdc_events(state, "quarantine")
    return state.appended("cdc_rejects", state.head()).select(
        "source_system", "source_record_id", "is_deleted", "last_kafka_offset", "violation"
    )


def _unassigned_results(orders):
    day = F.col("run_id")
    k = F.substring("transaction_id", 4, 20).cast("bigint")
    return (
        D.results_by_run(orders)
        .withColumn("left_source_system", F.concat(F.lit("book-"), day))
        .withColumn("reconciled_at", D.instant(F.lit(D.EPOCH) + k % 1000))
        .withColumn("run_id", F.when(day % 3 == 0, F.lit(1).cast("bigint")))
    )


@query
def runs_baseline_backfill(spark, sf_dir):
    runs, _ = R.backfill_baseline_runs(_unassigned_results(_orders(spark, sf_dir)), 2)
    return runs.drop("error_message")


@query
def results_baseline_backfill(spark, sf_dir):
    _, results = R.backfill_baseline_runs(_unassigned_results(_orders(spark, sf_dir)), 2)
    return results.select("left_source_system", "transaction_id", "currency", "run_id", "result_type")


@query
def table_difference(spark, sf_dir):
    """Line items against a copy that lacks some, holds some twice and lost some flags."""
    lines = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    key = F.col("l_orderkey")
    flag = F.when(key % 700 != 3, F.col("l_returnflag")).alias("l_returnflag")
    other = lines.where(key % 1000 != 7).select("l_orderkey", "l_suppkey", flag).unionByName(lines.where(key % 900 == 5))
    return difference.symmetric_difference(lines, other, ["l_orderkey"])


# -- quality -----------------------------------------------------------------


def _checkpointed(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return D.ledger_events(orders), D.half_way_checkpoints(orders)


@query
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_source_records(D.ledger(_orders(spark, sf_dir)))


def _incomplete_ledger(orders):
    """The ledger with a share of blanked and missing fields."""
    k = F.substring("transaction_id", 4, 20).cast("bigint")
    return D.ledger(orders).withColumns(
        {
            "status": F.when(k % 17 == 1, F.lit("  ")).otherwise(F.col("status")),
            "currency": F.when(k % 19 == 2, F.lit(None)).when(
                k % 19 == 3, F.lit("usd")).otherwise(F.col("currency")),
            "amount": F.when(k % 23 == 3, F.lit(None)).otherwise(F.col("amount")),
            "transaction_id": F.when(k % 29 == 4, F.lit("   ")).otherwise(F.col("transaction_id")),
        }
    )


@query
def dq_missing_fields(spark, sf_dir):
    return quality.missing_required_fields(_incomplete_ledger(_orders(spark, sf_dir)))


@query
def dq_non_positive(spark, sf_dir):
    return quality.non_positive_amounts(D.ledger(_orders(spark, sf_dir)))


@query
def dq_currency(spark, sf_dir):
    ledger = _incomplete_ledger(_orders(spark, sf_dir))
    return quality.unsupported_currency(ledger, quality.supported_currencies(spark))


@query
def dq_anomalies(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return quality.result_anomalies(D.results_by_run(orders), D.runs(orders))


@query
def dq_stale(spark, sf_dir):
    raw, marks = _checkpointed(spark, sf_dir)
    return quality.stale_events(raw, marks, D.instant(D.EPOCH + 800))


@query
def dq_all(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    raw, marks = _checkpointed(spark, sf_dir)
    checks = quality.run_checks(
        _incomplete_ledger(orders), quality.supported_currencies(spark),
        D.results_by_run(orders), D.runs(orders), raw, marks, D.instant(D.EPOCH + 800),
    )
    return checks.select(
        "executed_at", "check_name", "status", "affected_row_count", "details.description",
        "details.stale_after_seconds",
    )


# -- metrics -----------------------------------------------------------------


@query
def result_counts(spark, sf_dir):
    return metrics.result_counts(D.results(_orders(spark, sf_dir)))


def _lag(spark, sf_dir):
    """Lag of the ledger topic (checkpointed) and of the envelope topic (not),
    plus a checkpoint of a topic that has no events."""
    orders = _orders(spark, sf_dir)
    raw = D.ledger_events(orders).select("kafka_topic", "kafka_partition", "kafka_offset")
    stream = _parsed(spark, sf_dir).valid().select("kafka_topic", "kafka_partition", "kafka_offset")
    marks = D.half_way_checkpoints(orders)
    idle = marks.withColumn("kafka_topic", F.lit("cdc.idle"))
    return metrics.checkpoint_lag(raw.unionByName(stream), marks.unionByName(idle))


@query
def checkpoint_lag(spark, sf_dir):
    return _lag(spark, sf_dir)


@query
def total_lag(spark, sf_dir):
    return metrics.total_lag(_lag(spark, sf_dir))


def _bundle(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    raw, marks = _checkpointed(spark, sf_dir)
    dead = dedup.first_per_position(_parsed(spark, sf_dir).dead_letters())
    ledger = D.ledger(orders)
    results = R.reconcile(ledger, "book", "bank", 1, now())
    return metrics.metrics_bundle(raw, dead, ledger, results, D.runs(orders), marks, now())


@query
def reliability_metrics(spark, sf_dir):
    return _bundle(spark, sf_dir).summary.drop("reconciliation_result_counts")


@query
def metrics_bundle(spark, sf_dir):
    summary = _bundle(spark, sf_dir).summary
    return summary.select(
        "raw_cdc_event_count", "dlq_count",
        F.explode("reconciliation_result_counts").alias("result_type", "result_count"),
    )


# -- investigation -----------------------------------------------------------


def _with_total(page: investigate.Page) -> DataFrame:
    return page.items.withColumn("total", page.total.scalar())


@query
def runs_page(spark, sf_dir):
    page = investigate.runs_page(
        D.runs(_orders(spark, sf_dir)), left_source_system="book", status="SUCCEEDED", offset=20
    )
    return _with_total(page).drop("error_message")


@query
def runs_display(spark, sf_dir):
    return investigate.runs_display(D.runs(_orders(spark, sf_dir)))


@query
def results_page(spark, sf_dir):
    page = investigate.results_page(
        D.results(_orders(spark, sf_dir)), left_source_system="book", right_source_system="bank",
        result_type="MATCH", currency="eur", limit=200, offset=10,
    )
    return _with_total(investigate.Page(
        investigate.without_evidence(page.items), page.total, page.limit, page.offset))


@query
def results_page_far(spark, sf_dir):
    page = investigate.results_page(D.results(_orders(spark, sf_dir)), limit=150, offset=10_500)
    return _with_total(page).drop("reconciled_at")


@query
def results_page_index(spark, sf_dir):
    """A far page of stored results from the files it lies in, with the total of the fences."""
    state = LedgerState(spark, shared_folder(spark, "state"), buckets=16)
    jobs.put_ledger(state, D.ledger(_orders(spark, sf_dir)))
    jobs.run_reconciliation(state, "book", "bank")
    page = jobs.results_page(state, "book", "bank", limit=150, offset=10_500)
    return _result_columns(page.items).withColumn("total", F.lit(page.total).cast("bigint"))


@query
def results_page_evidence(spark, sf_dir):
    ledger = D.ledger(_orders(spark, sf_dir))
    page = investigate.results_page(
        R.reconcile(ledger, "book", "bank", 1, now()), result_type="DUPLICATE_RECORD", limit=100
    )
    evidence = investigate.page_evidence(page, R.evidence_rows(ledger, "book", "bank", 1))
    return evidence.select("transaction_id", "currency", "side", "source_record_id", "amount")


@query
def ledger_lookup(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    sides = F.explode(F.array(F.lit("book"), F.lit("bank")))
    keys = (
        orders.where(F.col("o_orderstatus") == "O")
        .select("o_orderkey", sides.alias("source_system"))
        .withColumn("source_record_id", F.concat("source_system", F.lit("-"), "o_orderkey"))
    )
    found, missing = investigate.ledger_lookup(D.ledger(orders), keys)
    shown = found.select("source_system", "source_record_id", "transaction_id", "amount")
    nothing = [F.lit(None).cast(shown.schema[c].dataType).alias(c) for c in ("transaction_id", "amount")]
    return shown.unionByName(missing.select("*", *nothing))


@query
def transaction_investigation(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.concat(F.lit("tx-"), "o_orderkey").alias("transaction_id")
    )
    strangers = D.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("tx-c"), "c_custkey").alias("transaction_id")
    )
    # Tables that are asked are stored ones; the ledger is derived once.
    folder = shared_folder(spark, "ledger")
    D.ledger(orders).write.parquet(folder)
    ledger = spark.read.parquet(folder)
    found = investigate.investigate_transactions(
        ledger, R.reconcile(ledger, "book", "bank", 1, now()), urgent.unionByName(strangers)
    )

    def part(df, section, first, second, status):
        return df.select(
            F.lit(section).alias("section"), "transaction_id", first.alias("a"),
            second.alias("b"), status.alias("status"),
        )

    none = F.lit(None).cast("string")
    return (
        part(found.ledger_records, "ledger", F.col("source_system"), F.col("source_record_id"),
             F.col("status"))
        .unionByName(part(found.results, "result", F.col("currency"), F.col("result_type"),
                          F.col("left_status")))
        .unionByName(part(found.not_found, "not found", none, none, none))
    )


@query
def quality_page(spark, sf_dir):
    page = investigate.quality_page(
        D.check_history(D.table(spark, sf_dir, "events")), check_name="check_click",
        executed_after=datetime(2024, 1, 10, tzinfo=timezone.utc), offset=5,
    )
    return _with_total(page).drop("details")


@query
def latest_quality_execution(spark, sf_dir):
    latest = investigate.latest_quality_execution(
        D.check_history(D.table(spark, sf_dir, "events"))
    )
    failures = investigate.quality_failures(latest).agg(F.max("failures")).scalar()
    return latest.drop("details").withColumn("failures", failures)
