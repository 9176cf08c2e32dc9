"""N-gram Jaccard join against plain sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyline.llm import graph, ngram_join, shingles
from tallyline.llm.storage import show_package
from tallyline.llm.text_arrays import text_bytes, word_bounds


def plain_set(text, size=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def plain(rows, percent=75):
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both, any_ = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both and 100 * both >= percent * any_:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(own, default=None) if sets[i] else doc_id))
    return out


def key(row):
    return tuple((x is not None, x or 0) for x in row)


def corpus(seed, base=12):
    rng = random.Random(seed)
    common = [f"common{i}" for i in range(40)]
    rows = []
    for b in range(base):
        words = [rng.choice(common) if rng.random() < 0.3 else f"w{b}x{i}" for i in range(rng.randint(3, 90))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"e{rng.random()}"
            rows.append(" ".join(copy[rng.randint(0, 2) :]))
    passage = " ".join(f"license{i}" for i in range(60))
    rows += [passage + f" tail{i} " * (i % 3) for i in range(12)]
    rows += [None, "", " \n", "A b", "a  B", "a b c", "É é x y z", "é é x y z", rows[0].upper(), rows[0]]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, pivots", [(1, (8, 64)), (2, (1,)), (3, ())])
def test_components_equal_plain_sets(spark, seed, pivots):
    show_package(spark)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, token string")
    got = ngram_join.near_duplicates(docs, pivots=pivots).collect()
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, plain(rows)))


def test_chains_hold_together_and_thresholds_are_exact(spark):
    show_package(spark)
    words = [f"v{i}" for i in range(60)]
    chain = [" ".join([*words[3 * k :], *(f"n{j}" for j in range(3 * k))]) for k in range(8)]
    # 7 shingles of 8 and 9, joined in 7 of 10, are 70 %; 6 of 8 are exactly 75 %.
    exact = ["p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11", "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 q"]
    rows = [(i, t) for i, t in enumerate([*chain, *exact])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.near_duplicates(docs).collect())) == sorted(plain(rows))


def test_null_ids_repeated_rows_and_empty_tables(spark):
    show_package(spark)
    rows = [(None, "one two three four five six"), (4, "one two three four five six"), (4, "one two three four five six"), (None, "x"), (None, "x"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(key, map(tuple, ngram_join.near_duplicates(docs).collect()))) == sorted(map(key, plain(rows)))
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0
    # One row of each text, whatever the ids; a clean text under the id of a copy stays.
    more = docs.union(spark.createDataFrame([(4, "a text of its own"), (2, "one two three four five six")], docs.schema))
    kept = ngram_join.drop_duplicates(more.withColumn("doc_id_", F.lit(1)))
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
        map(str, [Row(doc_id=2, text="one two three four five six"), Row(doc_id=None, text="x"),
                  Row(doc_id=4, text=None), Row(doc_id=4, text="a text of its own")]))
    assert ngram_join.drop_duplicates(docs.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aB \n\té漢\x0b", max_size=30), max_size=8))
def test_word_bounds_equal_the_pattern(texts):
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    start, end, firsts = word_bounds(data, bounds)
    raw = data.tobytes()
    got = [[raw[start[i] : end[i]].decode() for i in range(a, b)] for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    sets = list(shingles.shingle_sets(data, bounds))
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]


def test_words_longer_than_a_window_count_whole():
    long = "y" * (3 << 20)
    data, bounds = text_bytes(pa.array([f"a {long} b", f"a {long} b", f"a {long}y b"]))
    one, two, three = shingles.shingle_sets(data, bounds)
    assert one.tolist() == two.tolist() != three.tolist()


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)))
def test_suffix_filter_never_drops_a_link(x, y):
    a, b = (np.array(sorted(s), np.uint64) for s in (x, y))
    assert ngram_join.overlap_bound(a, b, 3) >= len(x & y)
    if x and y:
        assert ngram_join.linked(a, b, 75) == (100 * len(x & y) >= 75 * len(x | y))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300), (300, 301)]
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r.id: r.component for r in graph.components(frame).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}
    assert graph.components(frame.limit(0)).count() == 0


def opposite_words(size=2048):
    """Two different words of a and b that agree letter by letter in number and in many arrangements."""
    one = "a"
    while len(one) < size:
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_long_words_that_differ_in_their_arrangement_alone(spark):
    one, other = opposite_words()
    docs = spark.createDataFrame([(1, one), (2, other), (3, f"x {one}"), (4, f"x {other}"), (5, one)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
