"""Source mixing: targets, quotas, draws."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm import registry, source_mix


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_targets_fill_up_to_the_cap(sizes):
    weights = [source_mix.WEIGHTS[i % 3] for i in range(len(sizes))]
    total = sum(sizes)
    goal = source_mix.targets(sizes, weights, total)
    assert all(g <= 3 * s + 1e-6 for g, s in zip(goal, sizes, strict=True))
    assert sum(goal) == pytest.approx(total)
    level = [g / w for g, s, w in zip(goal, sizes, weights, strict=True) if g < 3 * s - 1e-6]
    assert not level or max(level) - min(level) < 1e-6 * max(level) + 1e-9
    capped = [g / w for g, s, w in zip(goal, sizes, weights, strict=True) if s and g >= 3 * s - 1e-6]
    assert not (level and capped) or max(capped) <= min(level) + 1e-6


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=8), st.integers(1, 20))
def test_quotas_stay_exact_and_shards_equal(quotas, shards):
    cut = source_mix.split_quotas(np.array(quotas), shards, 3)
    assert cut.shape == (shards, len(quotas))
    assert (cut >= 0).all()
    assert cut.sum(0).tolist() == quotas
    assert cut.sum(1).max() - cut.sum(1).min() <= shards


def test_split_has_the_hypergeometric_mean_and_spread():
    draws = np.array([source_mix.split_quotas(np.array([60, 30, 10]), 2, s)[0] for s in range(600)])
    assert np.allclose(draws.mean(0), [30, 15, 5], atol=0.5)
    assert np.allclose(draws.var(0), [50 * 0.6 * 0.4 * 50 / 99, 50 * 0.3 * 0.7 * 50 / 99, 50 * 0.1 * 0.9 * 50 / 99], rtol=0.3)


SCHEMA = "doc_id long, source string, text string, shard int, words string"


def mixed(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 0, "w") for r in rows], SCHEMA)
    sized, drawn, sources = source_mix.mix(docs, **options)
    return sized, drawn, sources


def test_blocks_are_disjoint_in_each_round_and_meet_the_target(spark):
    rows = [(i, "abc"[i % 3], "w " * (i % 40)) for i in range(900)]
    sized, drawn, sources = mixed(spark, rows, block_words=8, shards=4)
    blocks = drawn.collect()
    assert len({(b.round, b.doc_id, b.block) for b in blocks}) == len(blocks)
    assert len({(b.shard, b.place, b.doc_id, b.block) for b in blocks}) == len(blocks)
    for s in sources:
        own = [b for b in blocks if b.source == s["source"]]
        assert abs(sum(b.words for b in own) - s["target"]) <= 8 * 3
        shares = [sum(b.shard == k for b in own) / len(own) for k in range(4)]
        assert max(shares) - min(shares) < 0.15
    sizes = [sum(b.shard == k for b in blocks) for k in range(4)]
    assert max(sizes) - min(sizes) <= 4
    again = source_mix.draw(sized, sources, 8, 4, 11).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, blocks))


def test_query_over_whole_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs}
    source = {r.doc_id: r.source for r in docs}
    names = sorted(set(source.values()), key=str.encode)
    sizes = [sum(size[i] for i in size if source[i] == n) for n in names]
    weights = [(5, 2, 1)[k % 3] for k in range(len(names))]
    # The plain reading: cap, share the excess anew, repeat.
    goal, open_ = [0.0] * len(names), set(range(len(names)))
    while open_:
        left = sum(sizes) - sum(goal[k] for k in range(len(names)) if k not in open_)
        share = {k: left * weights[k] / sum(weights[j] for j in open_) for k in open_}
        over = {k for k in open_ if share[k] > 3 * sizes[k]}
        for k in over or open_:
            goal[k] = 3.0 * sizes[k] if over else share[k]
        open_ = open_ - over if over else set()
    rows = registry.op6_source_mix(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(size)
    taken = dict.fromkeys(names, 0)
    for r in rows:
        k = names.index(source[r.doc_id])
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[k])
        assert r.target == pytest.approx(goal[k])
        assert 0 <= r.taken <= 3 * r.size
        taken[names[k]] += r.taken
    assert all(abs(taken[n] - g) <= 256 * 2 for n, g in zip(names, goal, strict=True))


def test_null_empty_repeated_rows_and_tables(spark):
    rows = [(1, None, "a b c"), (1, None, "a b c"), (None, "s", "d e"), (2, "s", None), (3, "t", " "), (4, "é", "x " * 3000)]
    sized, drawn, sources = mixed(spark, rows, block_words=2, shards=3)
    got = source_mix.taken_words(sized, drawn, sources).collect()
    assert [s["source"] for s in sources] == ["s", "t", "é", None]
    assert len(got) == 6
    assert all(r.taken <= 3 * r.size for r in got)
    assert [r.taken for r in got if r.size == 0] == [0, 0]
    empty = mixed(spark, [])
    assert empty[1].count() == 0
    assert source_mix.taken_words(*empty).count() == 0


def test_whole_documents_keep_their_columns(spark):
    rows = [(i, "ab"[i % 2], f"w{i} " * 5) for i in range(200)]
    docs = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], SCHEMA)
    out = source_mix.mixed_documents(docs, shards=3)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text) for r in out.collect()} <= {(r[0], r[2]) for r in rows}
    counts = out.groupBy("source").count().collect()
    assert {r.source: r["count"] for r in counts} == pytest.approx({"a": 200 * 5 / 7, "b": 200 * 2 / 7}, abs=1)


def test_quotas_of_any_size_stay_exact():
    quotas = np.array([5 * 10**12 + 3, 7, 0, 10**9, 123_456_789_012])
    cut = source_mix.split_quotas(quotas, 16, 3)
    assert (cut >= 0).all() and cut.sum(0).tolist() == quotas.tolist()
    assert cut.sum(1).max() - cut.sum(1).min() < 1e-6 * quotas.sum()
    small = np.array([400, 30, 0, 999])
    assert (source_mix.split_quotas(small, 16, 3) == source_mix.split_quotas(small, 16, 3)).all()
