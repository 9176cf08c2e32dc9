"""Cross-entropy difference against dictionaries of counts."""

import math
import re
from collections import Counter

import pytest

from tallyline.llm import lm_difference, registry
from tallyline.llm.storage import show_package


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def plain(rows, target, word_share, bigram_share, weight):
    own = [(i, words(t)) for i, t in rows]
    uni = [Counter(), Counter()]
    for i, w in own:
        uni[0].update(w)
        if i is not None and i in target:
            uni[1].update(w)
    total = [sum(c.values()) for c in uni]
    known = {w for w, c in uni[0].items() if c >= word_share * total[0]}
    chance = [{w: (c[w] + 1) / (n + len(known) + 1) for w in known} for c, n in zip(uni, total, strict=True)]
    for c, n, p in zip(uni, total, chance, strict=True):
        p[None] = (n - sum(c[w] for w in known) + 1) / (n + len(known) + 1)
    pairs = [Counter(), Counter()]
    for i, w in own:
        w = [x if x in known else None for x in w]
        found = list(zip(["<start>", *w[:-1]], w, strict=True)) if w else []
        pairs[0].update(found)
        if i is not None and i in target:
            pairs[1].update(found)
    kept = {p for p, c in pairs[0].items() if c >= bigram_share * sum(pairs[0].values())}
    before = [Counter(), Counter()]
    for h, x in kept:
        for k in range(2):
            before[k][h] += pairs[k][h, x]
    out = []
    for i, w in own:
        w = [x if x in known else None for x in w]
        loss = [0.0, 0.0]
        for h, x in zip(["<start>", *w[:-1]], w, strict=True) if w else []:
            for k in range(2):
                count = pairs[k][h, x] if (h, x) in kept else 0
                loss[k] -= math.log((count + weight * chance[k][x]) / (before[k][h] + weight))
        out.append((i, len(w), *((loss[1] / len(w), loss[0] / len(w)) if w else (None, None))))
    return out


def check(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or 0)
    got = sorted(((r.doc_id, r.n_words, r.target_loss, r.background_loss) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[2:] == (None, None) if w[2] is None else g[2:] == pytest.approx(w[2:], rel=1e-9)


@pytest.mark.parametrize("word_share, bigram_share", [(0.0, 0.0), (0.05, 0.03), (0.9, 0.9)])
def test_same_losses_as_dictionaries(spark, word_share, bigram_share):
    show_package(spark)
    rows = [(1, "The cat sat the cat"), (2, "a dog ran THE dog"), (2, "a dog ran THE dog"), (3, None), (3, " "), (None, "the é cat"), (5, "cat " * 5000)]
    docs = spark.createDataFrame([(*r, True, 1.0) for r in rows], "doc_id long, text string, target boolean, n_words double")
    ids = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (2, "w"), (77, "v")], "doc_id long, text string")
    got = lm_difference.cross_entropy_difference(docs, ids, word_share, bigram_share, 2.0).collect()
    check(got, plain(rows, {1, 2}, word_share, bigram_share, 2.0))


def test_shuffled_ids_give_the_same(spark, monkeypatch):
    show_package(spark)
    rows = [(i, f"a b c{i % 3} d") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = docs.where("doc_id < 9").select("doc_id")
    one = lm_difference.cross_entropy_difference(docs, ids).orderBy("doc_id").collect()
    monkeypatch.setattr(lm_difference, "BROADCAST_IDS", 0)
    monkeypatch.setattr(lm_difference, "MERGE", 3)
    assert lm_difference.cross_entropy_difference(docs, ids).orderBy("doc_id").collect() == one


def test_empty_tables(spark):
    show_package(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm_difference.cross_entropy_difference(none, none).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lm_difference.cross_entropy_difference(docs, none).first().n_words == 2


def test_query_over_whole_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    check(registry.op5_lm_difference(spark, sf).collect(), plain(rows, good, 2e-6, 1e-6, 50.0))


def test_long_words_that_differ_in_their_arrangement_alone(spark):
    show_package(spark)
    one = "a"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{one} x {one}"), (2, f"{other} x"), (3, f"{one} {other}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm_difference.cross_entropy_difference(docs, docs.where("doc_id = 1").select("doc_id"), 0.0, 0.0, 2.0).collect()
    check(got, plain(rows, {1}, 0.0, 0.0, 2.0))
