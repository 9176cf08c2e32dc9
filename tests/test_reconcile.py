"""Classification, evidence, replacement, baseline runs, skewed keys."""

import itertools

import pytest
from helpers import DEAL_TYPES, DEALS, T0, deal_ledger, ledger_rows
from pyspark.sql import functions as F

from tallyline.operators import investigate
from tallyline.operators import reconcile as R
from tallyline.schemas import RESULTS


def now():
    return F.lit(T0)


@pytest.fixture(scope="module")
def ledger(spark):
    more = [
        ("shop", "gone", "deal-gone", "1", "EUR", "PAID", True),
        ("shop", "no-currency", "deal-null", "1", None, "PAID", False),
        ("broker", "x", "deal-0", "99", "EUR", "PAID", False),
    ]
    return deal_ledger(spark, more).cache()


def test_five_classes(ledger):
    rows = {r["transaction_id"]: r for r in R.reconcile(ledger, "shop", "bank", 1, now()).collect()}
    assert {k: r["result_type"] for k, r in rows.items()} == DEAL_TYPES
    sides = lambda deal: (rows[deal]["left_record_count"], rows[deal]["right_record_count"])
    assert [sides(f"deal-{i}") for i in range(6)] == [(1, 1), (0, 1), (1, 1), (1, 1), (1, 3), (1, 0)]
    assert (str(rows["deal-8"]["left_amount"]), str(rows["deal-8"]["right_amount"])) == ("139.0000", "140.0000")
    assert (rows["deal-3"]["left_status"], rows["deal-3"]["right_status"]) == ("OPEN", "PAID")


def test_duplicates_outrank_missing(spark):
    rows = [("l", "1", "t", "1", "USD", "A", False), ("l", "2", "t", "1", "USD", "A", False)]
    assert R.reconcile(ledger_rows(spark, rows), "l", "r", 1, now()).first()["result_type"] == "DUPLICATE_RECORD"


@pytest.mark.parametrize("left, right", [("", "b"), ("a", None), ("a", "a"), (None, "b")])
def test_pair_must_be_two_systems(ledger, left, right):
    with pytest.raises(ValueError, match="two distinct, non-empty"):
        R.reconcile(ledger, left, right, 1, now())


def test_evidence_is_complete_and_ordered(ledger):
    results = R.reconcile(ledger, "shop", "bank", 1, now())
    evidence = R.evidence_rows(ledger, "shop", "bank", 1)
    assert evidence.count() == len(DEALS)
    ordered = R.ordered_evidence(evidence).where("transaction_id = 'deal-10'").collect()
    assert [(r["side"], r["source_record_id"]) for r in ordered] == [
        ("left", "shop/10/0"), ("right", "bank/10/0"), ("right", "bank/10/1"), ("right", "bank/10/2")]
    # Evidence decides, not the counts that a result carries.
    some = evidence.where("transaction_id <> 'deal-1'")
    assert investigate.with_any_evidence(results, evidence).count() == 12
    assert investigate.with_any_evidence(results, some).count() == 11


def test_replace_touches_one_ordered_pair(spark, ledger):
    forward = R.reconcile(ledger, "shop", "bank", 1, now())
    backward = R.reconcile(ledger, "bank", "shop", 2, now())
    fresh = R.reconcile(ledger, "shop", "bank", 3, now())
    after = R.replace_pair(forward.unionByName(backward), fresh, "shop", "bank")
    assert {r["run_id"]: r["count"] for r in after.groupBy("run_id").count().collect()} == {2: 12, 3: 12}


def test_class_counts_add_up(ledger):
    results = R.reconcile(ledger, "shop", "bank", 1, now())
    run = R.run_summary(results, "shop", "bank", 1, now(), now()).first()
    names = [c for c in run.asDict() if c.endswith("_count") and c != "total_result_count"]
    assert run["total_result_count"] == 12 == sum(run[c] for c in names)
    assert sorted(run[c] for c in names) == [2, 2, 2, 2, 4]


def test_baseline_runs_number_every_pair_once(spark):
    pairs = [(f"l{i}", f"r{j}") for i, j in itertools.product(range(12), range(5))]
    rows = [(None if i % 4 else 1, l, r, f"tx{n}", "USD", "MATCH", 1, 1, None, None, "A", "A", T0)
            for i, (l, r) in enumerate(pairs) for n in range(3)]
    results = spark.createDataFrame(rows, RESULTS)
    runs, stamped = R.backfill_baseline_runs(results, 2)
    ids = sorted(r["run_id"] for r in runs.collect())
    assert ids == list(range(2, 2 + 45))
    by_pair = {(r[1], r[2]): r["run_id"] for r in runs.collect()}
    for r in stamped.collect():
        assert r["run_id"] == by_pair.get((r["left_source_system"], r["right_source_system"]), 1)
    assert stamped.count() == len(rows)


def brute_force(records, left, right):
    groups = {}
    for system, _, tx, amount, currency, status, deleted in records:
        if not deleted and currency is not None and system in (left, right):
            groups.setdefault((tx, currency), {left: [], right: []})[system].append((float(amount), status))
    out = {}
    for key, sides in groups.items():
        l, r = sides[left], sides[right]
        if len(l) > 1 or len(r) > 1:
            kind = "DUPLICATE_RECORD"
        elif not l or not r:
            kind = "MISSING_RECORD"
        elif l[0][0] != r[0][0]:
            kind = "AMOUNT_MISMATCH"
        elif l[0][1] != r[0][1]:
            kind = "STATUS_MISMATCH"
        else:
            kind = "MATCH"
        out[key] = (kind, len(l), len(r))
    return out


def test_one_key_with_a_third_of_all_records(spark):
    records = [("l" if i % 2 else "r", f"hot{i}", "hot", str(i), "USD", "A", False) for i in range(3000)]
    records += [(s, f"{s}{i}", f"tx{i}", str(10 + (i % 7 == 0 and s == "l")), "USD",
                 "B" if i % 11 == 0 and s == "r" else "A", i % 13 == 0 and s == "r")
                for i in range(3000) for s in ("l", "r")]
    ledger = ledger_rows(spark, records)
    found = {(r["transaction_id"], r["currency"]): (r["result_type"], r["left_record_count"], r["right_record_count"])
             for r in R.reconcile(ledger, "l", "r", 1, now()).collect()}
    assert found == brute_force(records, "l", "r")
    results = R.reconcile(ledger, "l", "r", 1, now())
    evidence = R.evidence_rows(ledger, "l", "r", 1)
    hot = R.ordered_evidence(evidence).where("transaction_id = 'hot'").select("side", "source_record_id").collect()
    assert hot == sorted(("left" if i % 2 else "right", f"hot{i}") for i in range(3000))
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Aggregate") == 2
