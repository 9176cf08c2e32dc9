"""Every link of the n-gram join against plain sets."""

import pytest

from tallyline.llm import ngram_join, registry
from tallyline.llm.storage import show_package
from test_ngram_join import corpus, key, plain, plain_set


def plain_links(rows, percent=75):
    sets = [plain_set(t) for _, t in rows]
    return [
        [j for j, y in enumerate(sets) if j != i and x & y and 100 * len(x & y) >= percent * len(x | y)] for i, x in enumerate(sets)
    ]


@pytest.mark.parametrize("seed", [1, 4])
def test_no_link_is_left_out(spark, seed):
    show_package(spark)
    words = [f"g{i}" for i in range(80)]
    near = [" ".join([*words[: 2 * k], f"odd{k}", *words[2 * k + 1 :]]) for k in range(40)]
    rows = corpus(seed)
    rows += [(1000 + i, t) for i, t in enumerate([*near, near[0], near[0]])] + [(None, near[1]), (7, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    linked = plain_links(rows)
    want = [(*p, len(x)) for p, x in zip(plain(rows), linked, strict=True)]
    assert sorted(map(key, map(tuple, ngram_join.linked_documents(docs).collect()))) == sorted(map(key, want))
    sets = [frozenset(plain_set(t)) for _, t in rows]
    first, size = {}, {}
    for (i, _), s in zip(rows, sets, strict=True):
        size[s] = size.get(s, 0) + 1
        first[s] = min((x for x in (first.get(s), i) if x is not None), default=None)
    pairs = {frozenset([sets[i], sets[j]]) for i, x in enumerate(linked) for j in x if sets[i] != sets[j]}
    named = sorted(sorted((first[s], size[s]) for s in p) for p in pairs)
    got = ngram_join.links(docs).collect()
    assert sorted(sorted([(r.doc_a, r.n_docs_a), (r.doc_b, r.n_docs_b)]) for r in got) == named


def test_query_agrees_with_the_components_alone(spark, sf):
    both = (q(spark, sf).select("doc_id", "n_shingles", "component_id").collect() for q in (registry.op1_ngram_join, registry.op1_ngram_links))
    one, other = (sorted(map(tuple, x)) for x in both)
    assert one == other
