"""How the derived inputs are dealt out to tasks."""

from pyspark.sql import functions as F

from tallyline.plans import derived as D


def test_derived_messages_are_dealt_out_by_rows(spark, monkeypatch):
    """Their bytes before rendering are few however long rendering takes."""
    monkeypatch.setattr(D, "ROWS_PER_TASK", 10)
    orders = spark.range(500).selectExpr(
        "id as o_orderkey", "'O' as o_orderstatus", "cast(1.5 as double) as o_totalprice", "timestamp'2024-01-01' as o_orderdate")
    events = spark.range(500).selectExpr("id as event_id", "'{}' as props", "timestamp'2024-01-01' as ts", "'view' as event_type")
    for df in (D.ledger_events(orders), D.envelope_messages(events), D.envelope_lines(events)):
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 40


def test_positions_of_ledger_events_render_no_text(spark, sf):
    """Storing events asks for their offsets first."""
    events = D.ledger_events(D.table(spark, sf, "orders"))
    plan = events.select("kafka_topic", "kafka_partition", "kafka_offset")._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan and "concat" not in plan and "date_format" not in plan
