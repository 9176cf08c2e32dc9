"""Ranked search against a plain reading of the score."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tallyline.llm import registry, term_pipeline
from tallyline.llm.storage import show_package

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERMS.findall((text or "").translate(UPPER))


def ranked(docs, items, k=10):
    """{item: [(doc_id, score), ..]} in order."""
    held = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(Counter)
    for item, text in items:
        asked[item].update(terms_of(text))
    out = {}
    for item, query in asked.items():
        scores = []
        for doc_id, c in held:
            m = 25 + 75 * c.total() * n_docs // n_terms
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, q in query.items()
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        if scores:
            out[item] = [(d, -s) for s, _, _, d in sorted(scores)[:k]]
    return out


def rows_of(found):
    out = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (str(r.item_id), r["rank"])):
        out[r.item_id].append((r["rank"], r.doc_id, r.score))
    for rows in out.values():
        assert [r[0] for r in rows] == [*range(1, len(rows) + 1)]
    return {i: [r[1:] for r in rows] for i, rows in out.items()}


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Straße", "ÉTÉ", "漢字"]
    docs = [(i, " ".join(draw.choices(words, [1 / (j + 1) for j in range(63)], k=draw.randint(1, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # copies: equal scores
    docs += [(None, docs[3][1]), (None, docs[3][1]), (5, "w1 w1"), (600, None), (601, ""), (602, "-- !"), (603, "W0 " * 5000 + "w59")]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 30)))) for i in range(25)]
    items += [(90, docs[7][1]), (91, None), (92, "?"), (93, "unknown"), (None, "w3 w4"), (94, "w50"), (94, "w51 w50")]
    return docs, items


@pytest.mark.parametrize("few", [1_000_000, 3])
def test_same_ranking_as_a_plain_reading(spark, corpus, few):
    show_package(spark)
    docs, items = corpus
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, term int, rank string").repartition(5)
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, score int")
    found = term_pipeline.top_k(table, asked, few_terms=few)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found) == ranked(docs, items)


def test_few_results_and_other_owners(spark, corpus):
    docs, items = corpus
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(term_pipeline.top_k(table, asked, k=2, bands=(0.05, 0.1, 0.3))) == ranked(docs, items, 2)
    assert rows_of(term_pipeline.top_k(table, asked, k=2000, bands=())) == ranked(docs, items, 2000)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "a")], "item_id string, text string")
    assert term_pipeline.top_k(docs, items.limit(0)).count() == 0
    assert term_pipeline.top_k(docs.limit(0), items).count() == 0
    assert [r.item_id for r in term_pipeline.top_k(docs, items).collect()] == ["x"]


def test_a_long_text_is_read_in_windows(monkeypatch):
    text = ("ab cd-ef " * 500 + "gh" * 300 + " x") * 3
    data = np.frombuffer(text.encode(), np.uint8)
    whole = term_pipeline._counted(data, np.array([0, len(data)]), term_pipeline._Wanted(None))
    monkeypatch.setattr(term_pipeline, "BLOCK_BYTES", 256)
    parts = term_pipeline._counted(data, np.array([0, len(data)]), term_pipeline._Wanted(None))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_large_products_stay_exact():
    lengths = np.array([3, 10**9], np.int64)
    n_docs, n_terms = 5 * 10**10, 10**13
    assert term_pipeline._lengths_factor(lengths, n_docs, n_terms).tolist() == [
        25 + 75 * n * n_docs // n_terms for n in lengths.tolist()
    ]


def test_query_agrees_with_its_sql(spark, sf):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    found = registry.op11_term_pipeline(spark, sf).select("item_id", "rank", "doc_id", "score")
    assert sorted(map(tuple, found.collect())) == sorted(db.execute(registry.all_oracles()["op11_term_pipeline"]).fetchall())
