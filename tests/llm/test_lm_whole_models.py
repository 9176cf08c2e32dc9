"""Rare words and bigrams keep their counts, in whatever way they are counted."""

import pytest

from tallyline.llm import lm_difference
from tallyline.llm.storage import show_package
from test_lm_difference import check, plain


def test_rare_bigrams_count_by_default(spark):
    show_package(spark)
    rows = [(1, "alpha beta gamma"), (2, "beta alpha gamma beta"), (3, "cat " * 1_200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = docs.where("doc_id = 1").select("doc_id")
    check(lm_difference.cross_entropy_difference(docs, ids).collect(), plain(rows, {1}, 0.0, 0.0, 50.0))


@pytest.mark.parametrize("shares", [(0.0, 0.0), (0.0, 0.02), (0.03, 0.0), (0.03, 0.02)])
@pytest.mark.parametrize("frequent", [0.0, 0.03, 0.9])
def test_frequent_or_not_gives_the_same(spark, monkeypatch, shares, frequent):
    show_package(spark)
    monkeypatch.setattr(lm_difference, "FREQUENT", frequent)
    rows = [(i % 19 or None, " ".join(f"w{(i * j * j) % (7 + j)}" for j in range(i % 13))) for i in range(60)]
    rows += [(1, rows[1][1]), (3, None), (4, "z z z z"), (4, "z z z z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids = spark.createDataFrame([(i,) for i in range(1, 8)], "doc_id long")
    got = lm_difference.cross_entropy_difference(docs, ids, *shares, 2.0).collect()
    check(got, plain(rows, set(range(1, 8)), *shares, 2.0))
