"""Insert-if-absent by message position."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyline.schemas import POSITION


def first_per_position(rows: DataFrame) -> DataFrame:
    """One row per (topic, partition, offset).

    Copies of a position are copies of one message. The aggregate behind
    ``dropDuplicates`` runs before the shuffle too, so a position delivered
    many times reaches the reducers once per map task.
    """
    return rows.dropDuplicates(POSITION)


def absent_rows(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows whose position ``stored`` does not hold yet, one per position."""
    return first_per_position(rows).join(stored.select(*POSITION), POSITION, "left_anti")
