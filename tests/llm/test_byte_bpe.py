"""Byte-level BPE against the tiktoken library."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm import byte_bpe, registry
from tallyline.llm.storage import show_package
from tallyline.llm.text_arrays import text_bytes

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = byte_bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def tool():
    return byte_bpe.Encoder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids_of(tool, texts):
    ids, firsts = tool.encode(*text_bytes(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]


def test_perfect_hash_is_minimal_and_exact():
    hashed = byte_bpe.PerfectHash(RANKS)
    assert sorted(hashed.slots.tolist()) == sorted(RANKS.values())
    keys = list(RANKS)
    assert hashed.find(keys).tolist() == list(RANKS.values())
    strange = [k + b"\xff\xfe\x00?" for k in keys[:5000]]
    assert [i for s, i in zip(strange, hashed.find(strange).tolist(), strict=True) if i >= 0 and s not in RANKS] == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab1 \n\t\r.,'sSté\x1c\x85\xa0  ’漢🙂　́ßİ\x00\x0b²½", max_size=40), max_size=30))
def test_same_ids_as_the_library(tool, library, texts):
    assert ids_of(tool, texts) == [library.encode_ordinary(t) for t in texts]


def test_long_texts_and_a_full_cache(library):
    small = byte_bpe.Encoder(PATH, public_tokenizers.PATTERN, most=50)
    texts = ["x" * 3000, "ab cd " * 2000, "".join(chr(97 + i % 26) for i in range(5000)), " " * 3000, None]
    for _ in range(2):
        assert ids_of(small, texts) == [library.encode_ordinary(t or "") for t in texts]


def test_words_that_differ_in_their_arrangement_alone(tool, library):
    one = "a"
    while len(one) < 4096:
        one += one.translate(str.maketrans("ab", "ba"))
    texts = [one, one.translate(str.maketrans("ab", "ba")), f"x {one}", "x " + one[::-1][:3000]]
    assert ids_of(tool, texts) == [library.encode_ordinary(t) for t in texts]


def test_decoding_restores_bytes(tool):
    texts = ["naïve — 漢字", "", "a\x00b"]
    ids, firsts = tool.encode(*text_bytes(pa.array(texts)))
    back = byte_bpe.Decoder(PATH)
    assert [back.decode(ids[a:b]).decode() for a, b in zip(firsts[:-1], firsts[1:], strict=True)] == texts
    assert back.decode(np.zeros(0, np.uint32)) == b""


def test_query_over_whole_documents(spark, sf, library):
    got = {r.doc_id: tuple(r)[1:] for r in registry.op8_byte_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id] == (len(ids), listed, hashlib.sha256((r.text or "").encode()).hexdigest())


def test_null_repeated_and_missing_rows(spark):
    show_package(spark)
    docs = spark.createDataFrame([(None, "a b", 1), (1, None, 2), (1, "a b", 3), (1, "a b", 3)], "doc_id long, text string, ids int")
    encoded = byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    rows = byte_bpe.digests(byte_bpe.decode(encoded, PATH)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 2), (1, 0), (1, 2), (1, 2)]
    assert [(r.ids_sha256, r.decoded_sha256) for r in rows if r.n_tokens == 0] == [(empty, empty)]
    assert byte_bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
