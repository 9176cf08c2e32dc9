"""Binary code search and near-duplicate vectors against brute force."""

import numpy as np
import pytest

from tallyline.llm import hamming_search, itq_dedup, registry, vector_codes
from tallyline.llm.storage import show_package


def brute(codes, ids, every, k):
    out = []
    for i in sorted(set(ids)):
        if i % every == 0:
            own = codes[ids.index(i)]
            near = sorted((int((own != c).sum()), j) for j, c in {j: c for j, c in zip(ids, codes, strict=True)}.items() if j != i)
            out += [(i, n + 1, j, d) for n, (d, j) in enumerate(near[:k])]
    return out


@pytest.mark.parametrize("dims", [64, 40, 100])
def test_search_is_exact(spark, dims, monkeypatch):
    show_package(spark)
    rng = np.random.default_rng(dims)
    near = rng.normal(size=(1, dims)) + 0.4 * rng.normal(size=(150, dims))
    vectors = np.concatenate([rng.normal(size=(250, dims)), near, np.repeat(near[:2], 40, 0)])
    ids = list(range(len(vectors)))
    rows = [(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = hamming_search.top_k(frame, every=20, k=7, dims=dims, block=150, queries=10)
    want = brute(vectors.astype(np.float32) > 0, ids, 20, 7)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_search_edge_rows(spark):
    show_package(spark)
    one = [1.0, -1.0, 0.0, 2.0]
    rows = [
        (0, one), (20, [1.0, 1.0, 1.0, 1.0]), (20, [1.0, 1.0, 1.0, 1.0]), (3, one), (None, one), (40, None), (60, [float("nan"), 1.0, 1.0, 1.0]),
        (80, [1.0]), (100, [None, 1.0, 1.0, 1.0]),
    ]
    frame = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "vec_id long, embedding array<float>, code string, distance double")
    got = sorted(map(tuple, hamming_search.top_k(frame, k=5, dims=4).collect()))
    assert got == [(0, 1, 3, 0), (0, 2, 20, 2), (20, 1, 0, 2), (20, 2, 3, 2)]
    assert hamming_search.top_k(frame.limit(0), dims=4).count() == 0


def test_radius_grows_until_covered():
    codes = vector_codes.packed(np.random.default_rng(0).random((3000, 64)) < 0.5)
    tables = hamming_search.Tables(codes)
    query, code, distance = tables.search(codes[:20], np.ones(3000, np.int64), 11)
    every = np.bitwise_count(codes[:20] ^ codes.T).astype(int)
    for q in range(20):
        last = np.sort(every[q])[10]
        assert sorted(code[query == q]) == np.flatnonzero(every[q] <= last).tolist()
        assert (distance[query == q] == every[q][code[query == q]]).all()


def links_of(vectors, least=0.95):
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = units @ units.T >= least
    np.fill_diagonal(linked, False)
    component = np.arange(len(vectors))
    while True:
        spread = np.array([min([component[i], *component[linked[i]]]) for i in range(len(vectors))])
        if (spread == component).all():
            return linked.sum(1), component
        component = spread


def test_links_and_recall_over_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    vectors = np.array([r.embedding for r in rows])
    ids = np.array([r.vec_id for r in rows])
    count, component = links_of(vectors)
    got = {r.vec_id: r for r in registry.op9_itq_dedup(spark, sf).collect()}
    assert len(got) == len(rows)
    found = np.array([got[i].n_links for i in ids])
    assert (found <= count).all()
    assert found.sum() >= 0.9 * count.sum()
    same = sum(got[i].component_id == ids[c] for i, c in zip(ids, component, strict=True))
    assert same >= 0.99 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_dedup_edge_rows(spark):
    show_package(spark)
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [
        (5, a), (2, a), (9, [1.0, 0.05, 0.0]), (1, b), (1, b), (7, [0.0] * 3), (8, None), (10, [float("inf"), 0.0, 0.0]), (11, [None, 1.0, 0.0]), (None, a), (12, [-1.0, 0.0, 0.0]),
    ]
    frame = spark.createDataFrame([(*r, 1, "w") for r in rows], "vec_id long, embedding array<float>, n_links int, words string")
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id, r.kept) for r in itq_dedup.deduplicate(frame, dims=3).collect())
    assert got == [
        (-1, 0, None, True), (1, 0, 1, True), (2, 2, 2, True), (5, 2, 2, False), (7, 0, 7, True), (8, 0, 8, True), (9, 2, 2, False), (10, 0, 10, True), (11, 0, 11, True), (12, 0, 12, True),
    ]
    assert itq_dedup.deduplicate(frame.limit(0), dims=3).count() == 0


def test_rotation_balances_and_stays_a_rotation():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(500, 8)) @ np.diag([9, 5, 3, 1, 1, 1, 0.5, 0.1])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    mean, projection = itq_dedup.learn_rotation(points)
    assert np.allclose(projection.T @ projection, np.eye(8), atol=1e-8)
    bits = (points - mean) @ projection > 0
    assert ((bits.mean(0) > 0.2) & (bits.mean(0) < 0.8)).all()
