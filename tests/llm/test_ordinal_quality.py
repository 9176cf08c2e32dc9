"""Ordinal regression: held-out accuracy, monotone tails, edge rows."""

import numpy as np
import pytest

from tallyline.llm import ordinal_quality as quality
from tallyline.llm import registry
from tallyline.llm.storage import show_package


def test_held_out_accuracy_and_ordered_thresholds(spark):
    show_package(spark)
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    grades = quality.label_grades(spark.read.parquet(f"{sf}/labels.parquet"))
    model = quality.train(docs, grades.where("doc_id % 4 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    rows = quality.score(docs, model, 2).join(grades.where("doc_id % 4 = 0"), "doc_id").collect()
    best = [r for r in rows if r.grade == 2]
    worst = [r for r in rows if r.grade == 0]
    toxic = [r for r in rows if r.grade == 1]
    assert sum(r.kept for r in best) >= 0.98 * len(best)
    assert sum(not r.kept for r in worst) >= 0.95 * len(worst)
    assert sum(not r.kept for r in toxic) >= 0.7 * len(toxic)
    mean = lambda x: np.mean([r.expected_grade for r in x])
    assert mean(worst) < mean(toxic) < mean(best)


def test_scores_follow_from_the_model(spark):
    show_package(spark)
    weights = np.zeros(quality.WIDTH, np.float32)
    data = np.frombuffer(b"bad bad word", np.uint8)
    _, ids, values = quality.features(data, np.array([0, len(data)]))
    weights[ids] = 0.5
    model = quality.OrdinalModel(weights, np.array([-1.0, 1.0]))
    docs = spark.createDataFrame([(1, "bad bad word", 3.0)], "doc_id long, text string, kept double")
    row = quality.score(docs, model, 1).first()
    tails = 1 / (1 + np.exp(np.array([-1.0, 1.0]) - (0.5 * values).sum()))
    assert row.expected_grade == pytest.approx(tails.sum(), rel=1e-6)
    assert row.tail_probability == pytest.approx(tails[0], rel=1e-6)


def test_gradient_of_the_likelihood():
    rng = np.random.default_rng(1)
    score, grades, bounds = rng.normal(size=30), rng.integers(0, 3, 30), np.array([-0.5, 0.8])

    def loss(s, b):
        edges = 1 / (1 + np.exp(-(np.concatenate([[-np.inf], b, [np.inf]])[:, None] - s)))
        return -np.log(edges[grades + 1, np.arange(30)] - edges[grades, np.arange(30)]).sum()

    slope, of_bounds = quality._residuals(score, grades, bounds)
    for k in range(30):
        step = np.eye(30)[k] * 1e-6
        assert slope[k] == pytest.approx((loss(score + step, bounds) - loss(score - step, bounds)) / 2e-6, abs=1e-4)
    for k in range(2):
        step = np.eye(2)[k] * 1e-6
        assert of_bounds[k] == pytest.approx((loss(score, bounds + step) - loss(score, bounds - step)) / 2e-6, abs=1e-4)


def test_edge_rows(spark):
    show_package(spark)
    texts = [(None, "good text here"), (1, None), (1, ""), (2, "junk!! " * 20_000), (2, "junk!! " * 20_000), (3, "漢字\x00 é")]
    docs = spark.createDataFrame([(*t, "x", True) for t in texts], "doc_id long, text string, grade string, kept boolean")
    nothing = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, grade int")
    assert quality.train(docs, nothing) is None
    assert all(r.kept and r.expected_grade is None for r in quality.score(docs, None, 2).collect())
    assert quality.keep(docs, None, 2).count() == 6
    rated = spark.createDataFrame([(1, 2), (2, 0), (2, 1), (3, 2), (9, 1)], "doc_id long, grade int")
    model = quality.train(docs, rated, least=1)
    rows = quality.score(docs, model, 2).collect()
    assert len(rows) == 6 and all(0 <= r.tail_probability <= 1 for r in rows)
    kept = quality.keep(docs, model, 2)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in rows)
    assert quality.score(docs.limit(0), model, 2).count() == 0


def test_query_covers_all_documents(spark, sf):
    rows = registry.op7_quality_grades(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.kept == (r.tail_probability >= 0.5) for r in rows)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [r.kept for r in rows if r.doc_id in labels and labels[r.doc_id].quality and not labels[r.doc_id].toxic]
    assert sum(clean) >= 0.97 * len(clean)
    bad = [r.kept for r in rows if r.doc_id in labels and not labels[r.doc_id].quality]
    assert sum(bad) <= 0.1 * len(bad)


def test_a_rated_id_counts_once_however_often_it_is_repeated(spark):
    show_package(spark)
    rows = [(i, f"{'good fine nice' if i % 2 else 'bad poor weak'} word{i % 5}") for i in range(40)]
    grades = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, grade int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = spark.createDataFrame([*rows, *[(3, "zzz other text")] * 300], "doc_id long, text string")
    a, b = quality.train(once, grades), quality.train(often, grades)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.thresholds, b.thresholds)


def test_query_against_a_plain_reading_of_the_fitted_model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.train(docs, quality.label_grades(spark.read.parquet(f"{sf}/labels.parquet")))
    got = {r.doc_id: r for r in registry.op7_quality_grades(spark, sf).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        _, ids, values = quality.features(data, np.array([0, len(data)]))
        score = sum(float(model.weights[i]) * float(v) for i, v in zip(ids, values, strict=True))
        tails = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        assert got[r.doc_id].expected_grade == pytest.approx(sum(tails), rel=1e-5, abs=1e-7)
        assert got[r.doc_id].tail_probability == pytest.approx(tails[1], rel=1e-5, abs=1e-7)
        assert got[r.doc_id].kept == (got[r.doc_id].tail_probability >= 0.5)
