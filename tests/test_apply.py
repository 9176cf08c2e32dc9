"""Eligibility, canonical values, latest per key, guarded upsert, checkpoints."""

import json

import pytest
from helpers import at, checkpoints, image, ledger_rows, raw_events
from pyspark.sql import functions as F

from tallyline.operators import apply as A
from tallyline.schemas import LEDGER

NOW = "2026-02-01"


def now():
    return F.lit(NOW).cast("timestamp")


def empty_ledger(spark):
    return spark.createDataFrame([], LEDGER)


def latest(spark, rows):
    found = A.latest_events(A.canonical_events(raw_events(spark, rows))).collect()
    return {(r["source_system"], r["source_record_id"]): r for r in found}


def test_image_overrides_key_and_key_fills_gaps(spark):
    key = '{"source_system":"a","source_record_id":"1","extra":5}'
    after = '{"source_record_id":"2","transaction_id":"t","amount":1.50,"currency":"usd","status":"x","extra":6}'
    rows = latest(spark, [{"offset": 0, "key": key, "after": after}])
    row = rows["a", "2"]
    assert (str(row["amount"]), row["currency"], row["status"]) == ("1.5000", "USD", "X")
    assert json.loads(row["source_payload"])["extra"] == 6


@pytest.mark.parametrize(
    "row, kept",
    [
        ({"after": image("a", "1")}, True),
        ({"after": image("a", "1", amount=None)}, False),
        ({"after": image("a", "1", status=None)}, False),
        ({"after": image("a", "1", amount="null")}, True),
        ({"before": image("a", "1", amount=None, currency=None, status=None), "op": "DELETE"}, True),
        ({"before": image("a", "1"), "after": "null", "op": "DELETE"}, True),
        ({"after": image("a", "", tx="t")}, False),
        ({"after": image("a", "1", source_record_id="null"), "key": '{"source_record_id":"9"}'}, False),
        ({"after": image("a", "1", transaction_id=None)}, False),
        ({"after": "[1]", "key": '{"source_system":"a","source_record_id":"1"}'}, False),
        ({"after": image("a", "1"), "key": '"text"'}, True),
        ({"after": None, "key": None}, False),
    ],
)
def test_eligibility(spark, row, kept):
    assert bool(A.canonical_events(raw_events(spark, [{"offset": 0, **row}])).count()) is kept


@pytest.mark.parametrize(
    "amount, expected",
    [
        ('"10.00005"', "10.0001"), ('"-10.00005"', "-10.0001"), ("12345678901234.5678", "12345678901234.5678"),
        ('"1e3"', "1000.0000"), ('""', None),
    ],
)
def test_amounts(spark, amount, expected):
    row = latest(spark, [{"offset": 0, "after": image("a", "1", amount=amount)}])["a", "1"]
    assert (None if row["amount"] is None else str(row["amount"])) == expected


@pytest.mark.parametrize(
    "fields, op, violation",
    [
        ({"amount": '"abc"'}, "INSERT", "amount"),
        ({"amount": '"NaN"'}, "INSERT", "amount"),
        ({"amount": '"99999999999999999"'}, "INSERT", "amount"),
        ({"amount": "null"}, "INSERT", "active record"),
        ({"amount": "null"}, "DELETE", None),
        ({"status": '""'}, "INSERT", "active record"),
        ({"currency": '"US"'}, "INSERT", "currency"),
        ({"currency": '"USD\\n"'}, "INSERT", "currency"),
        ({"currency": '"US"'}, "DELETE", "currency"),
        ({"updated_at": '"12:30:00"'}, "INSERT", "updated_at"),
        ({"updated_at": '"2026"'}, "INSERT", "updated_at"),
        ({"updated_at": '"2026-01-02T00:00:00+02:00"'}, "INSERT", None),
        ({}, "UPDATE", None),
    ],
)
def test_violations(spark, fields, op, violation):
    row = latest(spark, [{"offset": 0, "op": op, "after": image("a", "1", **fields)}])["a", "1"]
    if violation is None:
        assert row["violation"] is None
    else:
        assert row["violation"].startswith(violation)


def test_latest_by_time_topic_partition_offset(spark):
    rows = [
        {"offset": 9, "time": 1, "after": image("a", "1", tx="early")},
        {"offset": 1, "time": 2, "topic": "t", "after": image("a", "1", tx="topic t")},
        {"offset": 0, "time": 2, "topic": "u", "after": image("a", "1", tx="partition 0")},
        {"offset": 0, "time": 2, "topic": "u", "partition": 1, "after": image("a", "1", tx="offset 0")},
        {"offset": 3, "time": 2, "topic": "u", "partition": 1, "after": image("a", "1", tx="winner")},
    ]
    assert latest(spark, rows)["a", "1"]["transaction_id"] == "winner"


def test_event_time_falls_back(spark):
    rows = latest(spark, [
        {"offset": 0, "time": 9, "source_time": 8, "after": image("a", "1", updated_at='"2026-01-01T00:00:07Z"')},
        {"offset": 1, "time": 9, "source_time": 8, "after": image("a", "2", updated_at='""')},
        {"offset": 2, "time": 9, "after": image("a", "3")},
    ])
    seconds = {k[1]: r["source_event_timestamp"].timestamp() - at(0).timestamp() for k, r in rows.items()}
    assert seconds == {"1": 7, "2": 8, "3": 9}


def test_superseded_bad_row_is_harmless(spark):
    rows = [
        {"offset": 0, "after": image("a", "1", amount='"abc"')},
        {"offset": 1, "after": image("a", "1")},
    ]
    assert latest(spark, rows)["a", "1"]["violation"] is None


def test_upsert_takes_only_later_rows(spark):
    stored = ledger_rows(spark, [("a", "1", "old", "1", "USD", "X", False), ("a", "2", "old", "1", "USD", "X", False)])
    incoming = ledger_rows(
        spark,
        [("a", "1", "same time", "1", "USD", "X", False), ("a", "2", "later", "1", "USD", "X", False),
         ("a", "3", "new", "1", "USD", "X", False)],
    ).withColumn("last_kafka_offset", F.when(F.col("source_record_id") == "2", 5).otherwise(0).cast("bigint"))
    merged = {r["source_record_id"]: r["transaction_id"] for r in A.upsert_ledger(stored, incoming).collect()}
    assert merged == {"1": "old", "2": "later", "3": "new"}


def test_checkpoints_cover_ineligible_rows_and_never_fall(spark):
    raw = raw_events(spark, [{"offset": 3, "after": "[1]"}, {"offset": 7, "partition": 1, "after": "[1]"},
                             {"offset": 2, "topic": "z", "after": "[1]"}])
    marks = checkpoints(spark, [("t", 0, 1), ("z", 0, 5)])
    unseen = A.unseen_events(raw, marks)
    progress = A.partition_progress(unseen)
    after = {(r[0], r[1]): (r[2], r[3]) for r in A.advance_checkpoints(marks, progress, now()).collect()}
    assert {k: v[0] for k, v in after.items()} == {("t", 0): 3, ("t", 1): 7, ("z", 0): 5}
    assert after["z", 0][1] < after["t", 0][1]
    assert A.processed_count(progress).first()[0] == 2


def test_any_split_gives_the_same_ledger(spark, sf):
    from tallyline.plans import derived as D

    raw = D.ledger_events(D.table(spark, sf, "orders")).cache()
    whole = A.apply_events(raw, empty_ledger(spark), checkpoints(spark), now()).ledger
    for cut in (500, 4100):
        first = raw.where(F.col("kafka_offset") <= cut)
        one = A.apply_events(first, empty_ledger(spark), checkpoints(spark), now())
        two = A.apply_events(raw, one.ledger, one.checkpoints, now())
        assert two.ledger.exceptAll(whole).count() == 0 and whole.exceptAll(two.ledger).count() == 0
        # A replay has nothing left to process and changes nothing.
        three = A.apply_events(raw, two.ledger, two.checkpoints, now())
        assert three.processed.first()[0] == 0
        assert three.ledger.exceptAll(whole).count() == 0
    raw.unpersist()


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    raw = raw_events(spark, [{"offset": 0, "after": image("a", "1")}])
    plan = A.latest_events(A.canonical_events(raw))._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert any("WindowGroupLimit" in l and "Partial" in l for l in lines[exchange:])
