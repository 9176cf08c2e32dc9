"""Table schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Five result classes, the Debezium operation codes, the seeded
# currencies, the six check names with their descriptions.
RESULT_TYPES = (
    "MATCH",
    "MISSING_RECORD",
    "AMOUNT_MISMATCH",
    "STATUS_MISMATCH",
    "DUPLICATE_RECORD",
)
OPERATIONS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}
SUPPORTED_CURRENCIES = ("EUR", "GBP", "INR", "USD")
STALE_AFTER_SECONDS = 300
CHECK_DESCRIPTIONS = {
    "duplicate_source_records":
        "Active records sharing source system, transaction ID, and currency.",
    "missing_required_transaction_fields":
        "Active records with missing or blank canonical transaction fields.",
    "invalid_non_positive_amounts":
        "Active records whose amount is absent, zero, or negative.",
    "unsupported_invalid_currency":
        "Active records without an enabled supported three-letter currency.",
    "reconciliation_result_anomalies":
        "Current results inconsistent with their classification or successful run.",
    "stale_unprocessed_cdc_events":
        "Raw events older than five minutes and beyond the reconciliation checkpoint.",
}
ERROR_CLASS = "MalformedDebeziumEvent"
CURRENCY_PATTERN = r"\A[A-Z]{3}\z"
RUN_STATUSES = ("RUNNING", "SUCCEEDED", "FAILED")
CHECK_STATUSES = ("PASS", "FAIL")

AMOUNT = "decimal(20,4)"
PARTITION_KEY = ["kafka_topic", "kafka_partition"]
POSITION = [*PARTITION_KEY, "kafka_offset"]
LEDGER_KEY = ["source_system", "source_record_id"]


# Short names for the column types below.
_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "variant": T.VariantType(),
    "amount": T.DecimalType(20, 4),
}


def _schema(**columns: str | T.DataType) -> T.StructType:
    """Columns in order; a type name from ``_TYPES`` or a type per column."""
    return T.StructType(
        [T.StructField(n, _TYPES[t] if isinstance(t, str) else t) for n, t in columns.items()]
    )


# The Kafka source's own layout; file-based message streams use it too.
MESSAGES = _schema(
    key="binary",
    value="binary",
    topic="string",
    partition="int",
    offset="bigint",
    timestamp="timestamp",
    headers=T.ArrayType(_schema(key="string", value="binary")),
)

RAW_EVENTS = _schema(
    kafka_topic="string",
    kafka_partition="int",
    kafka_offset="bigint",
    consumer_group="string",
    kafka_timestamp="timestamp",
    source_database="string",
    source_schema="string",
    source_table="string",
    operation="string",
    event_timestamp="timestamp",
    source_timestamp="timestamp",
    source_lsn="string",
    source_tx_id="string",
    source_metadata="variant",
    transaction_metadata="variant",
    record_key="variant",
    before_payload="variant",
    after_payload="variant",
    payload="variant",
    ingested_at="timestamp",
)

DEAD_LETTERS = _schema(
    kafka_topic="string",
    kafka_partition="int",
    kafka_offset="bigint",
    consumer_group="string",
    kafka_timestamp="timestamp",
    record_key="binary",
    record_value="binary",
    record_headers=T.ArrayType(_schema(name="string", value_base64="string")),
    error_class="string",
    failure_reason="string",
    failed_at="timestamp",
)

LEDGER = _schema(
    source_system="string",
    source_record_id="string",
    transaction_id="string",
    amount="amount",
    currency="string",
    status="string",
    is_deleted="boolean",
    source_event_timestamp="timestamp",
    source_database="string",
    source_schema="string",
    source_table="string",
    last_kafka_topic="string",
    last_kafka_partition="int",
    last_kafka_offset="bigint",
    last_source_lsn="string",
    last_cdc_event_timestamp="timestamp",
    source_payload="string",
    refreshed_at="timestamp",
)

CHECKPOINTS = _schema(
    kafka_topic="string",
    kafka_partition="int",
    last_kafka_offset="bigint",
    updated_at="timestamp",
)

RUNS = _schema(
    run_id="bigint",
    left_source_system="string",
    right_source_system="string",
    started_at="timestamp",
    completed_at="timestamp",
    status="string",
    total_result_count="bigint",
    match_count="bigint",
    missing_record_count="bigint",
    amount_mismatch_count="bigint",
    status_mismatch_count="bigint",
    duplicate_record_count="bigint",
    error_message="string",
)

RESULTS = _schema(
    run_id="bigint",
    left_source_system="string",
    right_source_system="string",
    transaction_id="string",
    currency="string",
    result_type="string",
    left_record_count="bigint",
    right_record_count="bigint",
    left_amount="amount",
    right_amount="amount",
    left_status="string",
    right_status="string",
    reconciled_at="timestamp",
)

# One row per contributing record and side. A single (transaction, currency)
# may own a third of the ledger, so evidence is rows, never one array per result.
EVIDENCE = _schema(
    run_id="bigint",
    left_source_system="string",
    right_source_system="string",
    transaction_id="string",
    currency="string",
    side="string",
    source_record_id="string",
    amount="amount",
    status="string",
    source_event_timestamp="timestamp",
    kafka_topic="string",
    kafka_partition="int",
    kafka_offset="bigint",
    source_lsn="string",
    source_payload="string",
)

CHECK_RESULTS = _schema(
    executed_at="timestamp",
    check_name="string",
    status="string",
    affected_row_count="bigint",
    details=_schema(description="string", stale_after_seconds="int"),
)

REJECTS = T.StructType([*LEDGER.fields, T.StructField("violation", T.StringType())])
