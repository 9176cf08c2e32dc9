"""CDC inputs that Spark derives from the analytic tables, whole tables each.

Orders become ledger change events of two systems (``book`` and ``bank``) and
events become a stream of change envelopes, a share of them malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.apply import canonical_events, latest_events, storable
from tallyline.operators.reconcile import reconcile
from tallyline.schemas import AMOUNT, LEDGER, RAW_EVENTS, RUNS

EPOCH = 1767225600  # 2026-01-01T00:00:00Z
TOPIC = "cdc.ledger_entries"
# Orders or events that one task renders as messages.
ROWS_PER_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by ``key`` to as many tasks as their number asks for.

    They are narrow here and grow manyfold when texts are rendered from them and read again, so
    their bytes, by which adaptive execution would join partitions, say nothing of the work.
    A stream cannot be counted before it is read; it gets several tasks a core.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = 8 * cores if rows.isStreaming else max(cores, -(-rows.count() // ROWS_PER_TASK))
    return rows.repartition(tasks, key)


def instant(seconds: int | Column) -> Column:
    return F.timestamp_seconds(F.lit(seconds) if isinstance(seconds, int) else seconds)


def ledger_events(orders: DataFrame, defective: bool = False) -> DataFrame:
    """Raw CDC events: each order is booked once, and booked by the bank, booked
    twice, updated or deleted depending on its key.

    With ``defective`` a share of the orders carries faulty row images.
    """
    ruled = """case when k % 50 = 7 then 'JPY' when k % 5 = 1 then 'EUR'
                    when k % 5 = 2 then 'GBP' else 'USD' end"""
    capital = "case o_orderstatus when 'F' then 'SETTLED' when 'O' then 'PENDING' else 'POSTED' end"

    seconds = f"({EPOCH} + k * 10 + slot)"
    narrow = orders.selectExpr("o_orderkey as k", "o_orderstatus", "o_orderdate",
                               f"cast(o_totalprice as {AMOUNT}) as price")
    # An order becomes the numbers of its events, and columns are rendered from those one by one,
    # so that a reader of positions renders no text.
    rows = (
        # A topic arrives in many splits however its table was written: the narrow
        # source columns are dealt out before texts are rendered from them.
        dealt(narrow, "k")
        .selectExpr("k", "price as listed", "date_format(o_orderdate, 'yyyy-MM-dd') as day",
                    f"{ruled} as ruled", f"{capital} as capital",
                    """explode(case when k is null or k % 10 = 0 then array(0) when k % 10 = 3 then array(0, 1, 2)
                                    when k % 10 in (4, 5) then array(0, 1, 3) else array(0, 1) end) as slot""")
        .selectExpr(
            "k", "day", "slot",
            "case when slot < 3 then 'INSERT' when k % 10 = 4 then 'UPDATE' else 'DELETE' end as operation",
            "if(slot in (1, 2), 'bank', 'book') as system",
            f"""cast(case when slot < 2 and k % 100 = 6 then cast(0 as {AMOUNT})
                          when slot = 1 and k % 10 = 1 then cast(listed + 1.25 as {AMOUNT})
                          when slot = 3 then cast(listed + 5 as {AMOUNT}) else listed end as {AMOUNT}) as price""",
            "case when slot > 1 then 'USD' when slot = 0 and ruled = 'EUR' then 'eur' else ruled end as currency",
            """case when slot = 0 and capital = 'POSTED' then 'posted'
                    when slot = 1 and k % 10 = 2 then 'REVERSED' else capital end as status""",
        )
        .selectExpr("*", "concat(system, '-', k, if(slot = 2, '-b', '')) as record")
        .selectExpr(
            "*",
            f"timestamp_seconds{seconds} as event_timestamp",
            f"parse_json({_image(defective)}) as image_json",
            """parse_json(concat('{"source_system":"', system,
                                 '","source_record_id":"', record, '"}')) as record_key""",
        )
    )
    nothing = "parse_json('null')"
    return rows.selectExpr(
        f"'{TOPIC}' as kafka_topic",
        "cast(k % 3 as int) as kafka_partition",
        "k * 4 + slot as kafka_offset",
        "'ledger-ingestion' as consumer_group",
        "event_timestamp as kafka_timestamp",
        "'ledger_source' as source_database",
        "'public' as source_schema",
        "'ledger_entries' as source_table",
        "operation",
        "event_timestamp",
        f"case when k % 2 = 0 then timestamp_seconds({seconds} - 1) end as source_timestamp",
        "concat('lsn-', k * 4 + slot) as source_lsn",
        "cast(k as string) as source_tx_id",
        f"{nothing} as source_metadata",
        f"{nothing} as transaction_metadata",
        "record_key",
        f"if(operation = 'DELETE', image_json, {nothing}) as before_payload",
        f"if(operation = 'DELETE', {nothing}, image_json) as after_payload",
        f"{nothing} as payload",
        f"timestamp_seconds({EPOCH} + k % 1000) as ingested_at",
    ).select(*RAW_EVENTS.names)


def ledger_messages(events: DataFrame) -> DataFrame:
    """Raw ledger events as the CDC messages they come from, in the Kafka layout."""
    return events.selectExpr(
        "cast(to_json(record_key) as binary) as key",
        """cast(concat(
            '{"op":"', case operation when 'INSERT' then 'c' when 'UPDATE' then 'u' else 'd' end,
            '","before":', to_json(before_payload), ',"after":', to_json(after_payload),
            ',"source":{"db":"', source_database, '","schema":"', source_schema, '","table":"', source_table, '"',
            coalesce(concat(',"ts_ms":', unix_millis(source_timestamp)), ''),
            ',"lsn":"', source_lsn, '"},"ts_ms":', unix_millis(event_timestamp), '}') as binary) as value""",
        "kafka_topic as topic",
        "kafka_partition as partition",
        "kafka_offset as offset",
        "kafka_timestamp as timestamp",
        "cast(null as array<struct<key:string,value:binary>>) as headers",
    )


def _image(defective: bool) -> str:
    """Row image text; the bank writes its amount as a JSON number."""
    fault = "(k % 13)" if defective else "(-1)"
    return f"""case when {fault} = 10 then '[1]' else concat(
        '{{"source_system":"', system,
        '","source_record_id":', if({fault} = 8, 'null', concat('"', record, '"')),
        ',"transaction_id":"', if({fault} = 9, '', concat('tx-', k)), '"',
        if({fault} = 7, '', concat(',"amount":', case
            when {fault} = 1 then '"abc"'
            when {fault} = 2 then '"99999999999999999999"'
            when {fault} = 6 then '"NaN"'
            when system = 'bank' then cast(price as string)
            else concat('"', price, '"') end)),
        ',"currency":"', if({fault} = 3, 'US', currency),
        '","status":"', if({fault} = 4, '', status),
        '","updated_at":"', case
            when {fault} = 5 then 'yesterday'
            when k % 3 = 0 then ''
            else concat(day, 'T00:00:00Z') end,
        '"}}') end"""


def half_way_checkpoints(orders: DataFrame) -> DataFrame:
    """A checkpoint per partition at twice the number of orders, about half of
    the offsets. One aggregate row, spread over the three partitions."""
    return orders.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(TOPIC).alias("kafka_topic"),
        F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("kafka_partition"),
        (F.col("n") * 2).alias("last_kafka_offset"),
        instant(EPOCH).alias("updated_at"),
    )


def seen_events(raw: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """The other half: events at or below the checkpoint."""
    # All three checkpoints are equal by construction.
    mark = checkpoints.agg(F.max("last_kafka_offset")).scalar()
    return raw.where(F.col("kafka_offset") <= mark)


def ledger_of(raw: DataFrame) -> DataFrame:
    return storable(latest_events(canonical_events(raw)), instant(EPOCH))


def ledger(orders: DataFrame) -> DataFrame:
    return ledger_of(ledger_events(orders)).select(*LEDGER.names)


def results(orders: DataFrame, run_id: int = 1) -> DataFrame:
    return reconcile(ledger(orders), "book", "bank", run_id, instant(EPOCH))


def runs(orders: DataFrame) -> DataFrame:
    """A run per order day; its class counts are the day's orders per priority.

    Every seventh day failed and counted nothing; even days compare book with
    bank, odd days bank with book.
    """
    day = F.datediff("o_orderdate", F.lit("1970-01-01").cast("date"))
    priorities = {
        "match_count": "1-URGENT",
        "missing_record_count": "2-HIGH",
        "amount_mismatch_count": "3-MEDIUM",
        "status_mismatch_count": "4-NOT SPECIFIED",
        "duplicate_record_count": "5-LOW",
    }
    daily = orders.groupBy(day.alias("day")).agg(
        *[F.count_if(F.col("o_orderpriority") == p).alias(c) for c, p in priorities.items()]
    )
    failed = F.col("day") % 7 == 0
    counted = daily.select(
        "day", *[F.when(failed, F.lit(0)).otherwise(F.col(c)).alias(c) for c in priorities]
    )
    total = sum((F.col(c) for c in priorities), F.lit(0))
    even = F.col("day") % 2 == 0
    return (
        counted.withColumn("run_id", F.col("day").cast("bigint"))
        .withColumn("left_source_system", F.when(even, "book").otherwise("bank"))
        .withColumn("right_source_system", F.when(even, "bank").otherwise("book"))
        .withColumn("started_at", instant(F.col("day") * 86400))
        .withColumn("completed_at", instant(F.col("day") * 86400 + 60))
        .withColumn("status", F.when(failed, "FAILED").otherwise("SUCCEEDED"))
        .withColumn("total_result_count", total.cast("bigint"))
        .withColumn("error_message", F.when(failed, F.lit("source unavailable")))
        .select(*RUNS.names)
    )


def results_by_run(orders: DataFrame) -> DataFrame:
    """Results whose run is the order's day, so that some belong to failed runs
    or to the opposite pair; every eleventh is filed under the wrong class."""
    k = F.substring("transaction_id", 4, 20).cast("bigint")
    days = orders.select(
        F.concat(F.lit("tx-"), "o_orderkey").alias("transaction_id"),
        F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")).cast("bigint").alias("day"),
    )
    base = results(orders)
    return (
        base.join(days, "transaction_id")
        .withColumn("run_id", F.col("day"))
        .withColumn(
            "result_type", F.when(k % 11 == 0, "AMOUNT_MISMATCH").otherwise(F.col("result_type"))
        )
        .select(*base.columns)
    )


def check_history(events: DataFrame) -> DataFrame:
    """A check per event type and hour, affected rows being events above 300."""
    hourly = events.groupBy(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("executed_at"),
        F.concat(F.lit("check_"), "event_type").alias("check_name"),
    ).agg(F.count_if(F.col("value") > 300).alias("affected_row_count"))
    return hourly.select(
        "executed_at",
        "check_name",
        F.when(F.col("affected_row_count") == 0, "PASS").otherwise("FAIL").alias("status"),
        "affected_row_count",
        F.struct(
            F.concat(F.lit("Events of "), "check_name").alias("description"),
            F.lit(None).cast("int").alias("stale_after_seconds"),
        ).alias("details"),
    )


def _with_envelopes(rows: DataFrame) -> DataFrame:
    """Add the envelope ``text`` of an event in its form ``kind``, of which 1 to
    8 are malformed."""
    return rows.selectExpr(
        "*", """concat('{"marker":"m-', event_id, '","props":', props, '}') as image"""
    ).selectExpr(
        "*",
        """concat(
            '{"before":', if(kind in (9, 10), image, 'null'),
            ',"after":', if(kind in (3, 9), 'null', image),
            ',"source":{"db":"', if(kind = 6, '', 'ledger_source'),
            '","schema":"public","table":"cdc_smoke","ts_ms":',
            if(kind = 13, 'null', cast(ms - 96 as string)),
            ',"txId":', event_id, ',"lsn":', event_id * 8,
            '},"transaction":{"id":"', event_id, ':1","total_order":1},"op":"',
            case kind when 4 then 'x' when 9 then 'd' when 10 then 'u' when 14 then 'r' else 'c' end,
            '"', case kind when 12 then '' when 5 then concat(',"ts_ms":"', ms, '"')
                           when 15 then concat(',"ts_ms":', ms, '.5')
                           else concat(',"ts_ms":', ms) end,
            '}') as envelope""",
    ).selectExpr(
        *rows.columns,
        """case kind when 1 then 'not-json' when 2 then '{}' when 8 then '{"payload":null}'
                     when 11 then concat('{"payload":', envelope, '}')
                     else envelope end as text""",
    )


def envelope_messages(events: DataFrame) -> DataFrame:
    """The events as CDC messages in the Kafka layout. Sixteen forms take turns,
    eight of them malformed, and every twentieth message is delivered twice."""
    narrow = events.selectExpr(
        "event_id",
        "props",
        "event_id % 16 as kind",
        "unix_millis(cast(ts as timestamp)) as ms",
    )
    rows = dealt(narrow, "event_id").selectExpr("*", "explode(if(event_id % 20 = 0, array(0, 1), array(0))) as copy")
    return _with_envelopes(rows).selectExpr(
        """cast(if(kind = 7, '{broken', concat('{"marker":"m-', event_id, '"}')) as binary) as key""",
        "cast(text as binary) as value",
        "'cdc.events' as topic",
        "cast(event_id % 3 as int) as partition",
        "event_id div 3 as offset",
        "timestamp_millis(if(kind = 0, -1, ms)) as timestamp",
        "array(struct('trace' as key, cast('abc' as binary) as value)) as headers",
    )


def envelope_lines(events: DataFrame) -> DataFrame:
    """The events as well-formed JSON lines, some delivered twice, some wrapped,
    some of another operation or table, with blank lines in between."""
    # Of the envelope forms only those that are valid JSON and hold an image.
    narrow = events.selectExpr(
        "event_id",
        "props",
        "case event_type when 'click' then 9 when 'error' then 11 when 'view' then 14 else 0 end as kind",
        "unix_millis(cast(ts as timestamp)) as ms",
    )
    rows = dealt(narrow, "event_id").selectExpr("*", "explode(if(event_id % 20 = 0, array(0, 1, 2), array(0, 2))) as copy")
    return _with_envelopes(rows).selectExpr("if(copy = 2, '  ', text) as line")
