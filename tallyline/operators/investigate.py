"""Filtered, paged and batched lookups over the tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.schemas import (
    CHECK_RESULTS,
    CHECK_STATUSES,
    LEDGER_KEY,
    RESULT_TYPES,
    RESULTS,
    RUN_STATUSES,
    RUNS,
)

# Page size limits.
DEFAULT_LIMIT = 50
MAX_LIMIT = 200


@dataclass(frozen=True)
class Page:
    items: DataFrame
    total: DataFrame
    limit: int
    offset: int


def _one_of(name: str, value: str | None, allowed: tuple[str, ...]) -> None:
    if value is not None and value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}")


def matching(df: DataFrame, equal: dict[str, object]) -> DataFrame:
    """Rows that meet every filter that was given; values bind as literals."""
    for column, value in equal.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def page_of(df: DataFrame, order: list[Column], limit: int, offset: int) -> Page:
    """The requested slice and the total, both lazy.

    Each task keeps its first ``offset + limit`` rows, without a sort of the whole. Far pages of a
    published table come from :mod:`page_index`, and readers that go on from page to page use
    :func:`page_after`; neither depends on the offset.
    """
    if not 1 <= limit <= MAX_LIMIT or offset < 0:
        raise ValueError(f"limit must be 1..{MAX_LIMIT} and offset not negative")
    return Page(df.orderBy(*order).offset(offset).limit(limit), df.agg(F.count(F.lit(1)).alias("total")), limit, offset)


def page_after(
    df: DataFrame, keys: list[tuple[str, bool]], last: tuple | None, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    """The ``limit`` rows that follow the sort key ``last`` (None: the first ones).

    ``keys`` are (column, descending); together they identify a row.
    """
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be 1..{MAX_LIMIT}")
    if last is not None:
        beyond, same = F.lit(False), F.lit(True)
        for (name, down), value in zip(keys, last, strict=True):
            column = F.col(name)
            beyond = beyond | (same & ((column < F.lit(value)) if down else (column > F.lit(value))))
            same = same & (column == F.lit(value))
        df = df.where(beyond)
    return df.orderBy(*(F.desc(c) if down else F.asc(c) for c, down in keys)).limit(limit)


def runs_page(
    runs: DataFrame,
    left_source_system: str | None = None,
    right_source_system: str | None = None,
    status: str | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> Page:
    _one_of("status", status, RUN_STATUSES)
    rows = matching(
        runs.select(*RUNS.names),
        {
            "left_source_system": left_source_system,
            "right_source_system": right_source_system,
            "status": status,
        },
    )
    return page_of(rows, [F.desc("run_id")], limit, offset)


def results_page(
    results: DataFrame,
    run_id: int | None = None,
    left_source_system: str | None = None,
    right_source_system: str | None = None,
    result_type: str | None = None,
    transaction_id: str | None = None,
    currency: str | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> Page:
    _one_of("result_type", result_type, RESULT_TYPES)
    if currency is not None and len(currency) != 3:
        raise ValueError("currency must have three letters")
    if run_id is not None and run_id < 1:
        raise ValueError("run_id must be positive")
    rows = matching(
        results,
        {
            "run_id": run_id,
            "left_source_system": left_source_system,
            "right_source_system": right_source_system,
            "result_type": result_type,
            "transaction_id": transaction_id,
            "currency": currency.upper() if currency else None,
        },
    )
    order = [F.desc("reconciled_at"), F.asc("transaction_id"), F.asc("currency")]
    return page_of(rows, order, limit, offset)


def page_evidence(page: Page, evidence: DataFrame) -> DataFrame:
    """All evidence of a page's results; the page is at most 200 rows."""
    keys = ["left_source_system", "right_source_system", "transaction_id", "currency"]
    return evidence.join(F.broadcast(page.items.select(*keys)), keys, "left_semi")


def quality_page(
    checks: DataFrame,
    check_name: str | None = None,
    status: str | None = None,
    executed_after: datetime | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> Page:
    _one_of("status", status, CHECK_STATUSES)
    rows = matching(checks.select(*CHECK_RESULTS.names), {"check_name": check_name, "status": status})
    if executed_after is not None:
        rows = rows.where(F.col("executed_at") >= F.lit(executed_after))
    return page_of(rows, [F.desc("executed_at"), F.asc("check_name")], limit, offset)


def ledger_lookup(ledger: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Current records of the requested (system, record) keys, and the keys that
    have none. Ledger keys are unique, so neither join has a hot key."""
    wanted = keys.select(*LEDGER_KEY).distinct()
    found = ledger.join(wanted, LEDGER_KEY, "left_semi")
    return found, wanted.join(ledger.select(*LEDGER_KEY), LEDGER_KEY, "left_anti")


@dataclass(frozen=True)
class Investigation:
    ledger_records: DataFrame
    results: DataFrame
    not_found: DataFrame


def investigate_transactions(
    ledger: DataFrame, results: DataFrame, transaction_ids: DataFrame
) -> Investigation:
    """Ledger rows and results of the requested transactions, and those of which
    neither table knows anything. All three are lazy."""
    key = ["transaction_id"]
    wanted = transaction_ids.select(*key).distinct()
    records, compared = (df.join(wanted, key, "left_semi") for df in (ledger, results))
    known = records.select(*key).union(compared.select(*key)).distinct()
    return Investigation(
        records.orderBy("source_system", "source_record_id"),
        compared.orderBy("left_source_system", "right_source_system", "currency"),
        wanted.join(known, key, "left_anti"),
    )


def latest_quality_execution(checks: DataFrame) -> DataFrame:
    """All check rows of the newest execution."""
    newest = checks.agg(F.max("executed_at").alias("t")).scalar()
    return checks.where(F.col("executed_at") == newest)


def quality_failures(latest: DataFrame) -> DataFrame:
    return latest.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status") == "FAIL").alias("failures")
    )


def runs_display(runs: DataFrame) -> DataFrame:
    """Run rows as shown to people: pair in one column, short count names."""
    return runs.select(
        "run_id",
        "status",
        "completed_at",
        F.concat_ws(" → ", "left_source_system", "right_source_system").alias("source_pair"),
        F.col("total_result_count").alias("total"),
        F.col("match_count").alias("match"),
        F.col("missing_record_count").alias("missing"),
        F.col("amount_mismatch_count").alias("amount_mismatch"),
        F.col("status_mismatch_count").alias("status_mismatch"),
        F.col("duplicate_record_count").alias("duplicate"),
    )


def without_evidence(results: DataFrame) -> DataFrame:
    return results.select(*RESULTS.names)


def with_any_evidence(results: DataFrame, evidence: DataFrame) -> DataFrame:
    """Results that have evidence on either side."""
    key = [c for c in RESULTS.names if c in (
        "left_source_system", "right_source_system", "transaction_id", "currency")]
    return results.join(evidence.select(*key), key, "left_semi")
