"""Pages, lookups, displays and the quality checks' single functions."""

from datetime import datetime, timezone

import pytest
from helpers import T0, at, deal_ledger, ledger_rows
from pyspark.sql import functions as F

from tallyline.operators import investigate as I
from tallyline.operators import metrics, quality
from tallyline.operators import reconcile as R
from tallyline.schemas import CHECK_RESULTS, CHECKPOINTS, RUNS


@pytest.fixture(scope="module")
def ledger(spark):
    return deal_ledger(spark).cache()


@pytest.fixture(scope="module")
def results(ledger):
    return R.reconcile(ledger, "shop", "bank", 1, F.lit(T0)).cache()


@pytest.fixture(scope="module")
def runs(spark):
    rows = [(n, "l" if n % 2 else "m", "r", at(n), at(n + 1), "FAILED" if n % 5 == 0 else "SUCCEEDED",
             n, n, 0, 0, 0, 0, None) for n in range(1, 301)]
    return spark.createDataFrame(rows, RUNS).repartition(4).cache()


def ids(page):
    return [r["run_id"] for r in page.items.collect()]


def test_runs_page(runs):
    page = I.runs_page(runs)
    assert ids(page) == list(range(300, 250, -1)) and page.total.first()[0] == 300
    page = I.runs_page(runs, left_source_system="l", status="FAILED", limit=3, offset=2)
    assert ids(page) == [275, 265, 255] and page.total.first()[0] == 30
    assert ids(I.runs_page(runs, right_source_system="nobody")) == []


def test_pages_at_any_offset(runs):
    assert ids(I.runs_page(runs, limit=37, offset=120)) == list(range(180, 143, -1))
    assert ids(I.runs_page(runs, limit=37, offset=290)) == list(range(10, 0, -1))
    assert ids(I.runs_page(runs, limit=37, offset=301)) == []
    page = I.page_of(runs, [F.desc("run_id")], 5, 100)
    assert ids(page) == [200, 199, 198, 197, 196]


def test_paging_by_the_last_key(runs):
    keys = [("status", False), ("run_id", True)]
    want = [(r["status"], r["run_id"]) for r in runs.orderBy("status", F.desc("run_id")).collect()]
    seen, last = [], None
    while True:
        page = [(r["status"], r["run_id"]) for r in I.page_after(runs, keys, last, 70).collect()]
        if not page:
            break
        seen, last = seen + page, page[-1]
    assert seen == want


@pytest.mark.parametrize("bad", [{"limit": 0}, {"limit": 201}, {"offset": -1}, {"status": "DONE"}])
def test_invalid_page_requests(runs, bad):
    with pytest.raises(ValueError):
        I.runs_page(runs, **bad)


def test_results_page(results):
    page = I.results_page(results, currency="eur", result_type="MATCH")
    assert [r["transaction_id"] for r in page.items.collect()] == ["deal-0", "deal-6"]
    assert [r["transaction_id"] for r in I.results_page(results, run_id=1, limit=3).items.collect()] == [
        "deal-0", "deal-1", "deal-10"]
    for bad in ({"currency": "US"}, {"run_id": 0}, {"result_type": "OTHER"}):
        with pytest.raises(ValueError):
            I.results_page(results, **bad)
    # A filter value is data, never SQL.
    assert I.results_page(results, transaction_id="' OR 1=1 --").items.isEmpty()


def test_page_evidence(ledger, results):
    page = I.results_page(results, transaction_id="deal-4")
    found = I.page_evidence(page, R.evidence_rows(ledger, "shop", "bank", 1))
    assert found.count() == 4


def test_lookups(spark, ledger, results):
    keys = spark.createDataFrame([("bank", "bank/4/2"), ("bank", "none")],
                                 "source_system string, source_record_id string")
    found, missing = I.ledger_lookup(ledger, keys.union(keys))
    assert [r["transaction_id"] for r in found.collect()] == ["deal-4"]
    assert [tuple(r) for r in missing.collect()] == [("bank", "none")]
    wanted = spark.createDataFrame([("deal-10",), ("deal-none",)], "transaction_id string")
    seen = I.investigate_transactions(ledger, results, wanted)
    assert [r["source_record_id"] for r in seen.ledger_records.collect()] == [
        "bank/10/0", "bank/10/1", "bank/10/2", "shop/10/0"]
    assert seen.results.count() == 1
    assert [r[0] for r in seen.not_found.collect()] == ["deal-none"]


def test_quality_pages(spark):
    rows = [(at(t), f"check{c}", "FAIL" if (t + c) % 3 == 0 else "PASS", c, ("d", None))
            for t in range(4) for c in range(3)]
    checks = spark.createDataFrame(rows, CHECK_RESULTS)
    page = I.quality_page(checks, status="FAIL", executed_after=datetime(2026, 1, 1, 0, 0, 2, tzinfo=timezone.utc))
    assert [(r["executed_at"].timestamp() - T0.timestamp(), r["check_name"]) for r in page.items.collect()] == [
        (3, "check0"), (2, "check1")]
    latest = I.latest_quality_execution(checks)
    assert latest.count() == 3
    assert tuple(I.quality_failures(latest).first()) == (3, 1)


def test_runs_display(runs):
    row = I.runs_display(runs).where("run_id = 1").first()
    assert row["source_pair"] == "l → r" and row["match"] == 1


def test_lag_cases(spark):
    raw = spark.createDataFrame([("a", 0, 9), ("a", 0, 4), ("b", 0, 9), ("d", 0, 3)],
                                "kafka_topic string, kafka_partition int, kafka_offset bigint")
    marks = spark.createDataFrame([("a", 0, 4, T0), ("c", 0, 7, T0), ("d", 0, 8, T0)], CHECKPOINTS)
    lag = metrics.checkpoint_lag(raw, marks)
    assert {r["kafka_topic"]: r["lag"] for r in lag.collect()} == {"a": 5, "b": 10, "c": 0, "d": 0}
    assert metrics.total_lag(lag).first()[0] == 15


def test_ledger_checks_agree_with_single_checks(spark):
    rows = [
        ("s", "1", "t", "1", None, "A", False), ("s", "2", "t", "1", None, "A", False),
        ("s", "3", " ", None, "usd", "A", False), ("s", "4", "u", "-1", "EUR", " ", False),
        ("s", "5", "\t", "1", "USD\n", "A", False), ("s", "6", "v", "1", "JPY", "A", False),
        ("s", "7", "w", None, None, None, True), ("s", "8", "x", "1", "GBP", "A", False),
    ]
    ledger = ledger_rows(spark, rows)
    currencies = quality.supported_currencies(spark).union(
        spark.createDataFrame([("JPY", False), ("GBP", True)], "currency string, enabled boolean"))
    found = {r["check_name"]: r["affected_row_count"] for r in quality.ledger_checks(ledger, currencies).collect()}
    assert found == {
        "duplicate_source_records": quality.duplicate_source_records(ledger).first()[0],
        "missing_required_transaction_fields": quality.missing_required_fields(ledger).first()[0],
        "invalid_non_positive_amounts": quality.non_positive_amounts(ledger).first()[0],
        "unsupported_invalid_currency": quality.unsupported_currency(ledger, currencies).first()[0],
    } == {
        "duplicate_source_records": 2, "missing_required_transaction_fields": 4,
        "invalid_non_positive_amounts": 2, "unsupported_invalid_currency": 5,
    }
