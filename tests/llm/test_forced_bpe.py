"""Byte-level BPE by forced boundaries against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyline.llm import forced_bpe, registry
from tallyline.llm.storage import show_package
from tallyline.llm.text_arrays import text_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def tool():
    return forced_bpe.Encoder(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(tool, texts):
    ids, firsts = tool.encode(*text_bytes(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]


def expected(library, texts):
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_no_token_holds_a_forced_pair(tool):
    inside = tool.vocabulary.inside
    assert inside[ord("t"), ord("h")] and inside[ord(" "), ord("t")]
    assert not inside[ord("t"), ord(" ")]
    data, first = tool.fragments([" naïve".encode(), "a漢🙂b".encode(), b"the"])
    assert data.tobytes() == " naïvea漢🙂bthe".encode()
    assert {0, 7, 8, 15} <= set(first.tolist()) and data[first[-1] :].tobytes() == b"the"


@settings(max_examples=25, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text("ab1 \n\t\r.,'sSté\x1c\x85\xa0  ’漢🙂　́ßİ\x00\x0b²½՘\U0001e6c0<|>endoftx", max_size=40),
            st.text(max_size=12),
            st.sampled_from([SPECIAL, f" {SPECIAL}  {SPECIAL}", f"a  {SPECIAL}b", SPECIAL[:6], SPECIAL[6:]]),
        ),
        max_size=20,
    )
)
def test_same_ids_as_the_library(tool, library, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    found = ids_of(tool, texts)
    assert found == expected(library, texts)
    back = forced_bpe.Decoder(PATH)
    assert [back.decode(np.array(x, np.int64)) for x in found] == [library.decode(x, skip_special_tokens=False) for x in found]


@settings(max_examples=40, deadline=None)
@given(st.text("ab cdefgh" + "aeiost" * 3, min_size=1, max_size=300))
def test_both_ways_to_merge_agree(tool, text):
    data = np.frombuffer(text.encode()[: forced_bpe.SHORT], np.uint8)
    ids, count = tool.merge(np.concatenate([data, data[::-1]]), np.array([0, len(data)]))
    ways = [forced_bpe.merge_long(tool.byte_ids[x].tolist(), tool.vocabulary.merges) for x in (data, data[::-1])]
    assert ids.tolist() == ways[0] + ways[1] and count.tolist() == [len(w) for w in ways]


def test_long_texts_and_little_memory(library):
    small = forced_bpe.Encoder(PATH, most=200)
    swapped = "a"
    while len(swapped) < 4096:
        swapped += swapped.translate(str.maketrans("ab", "ba"))
    texts = [
        "x" * 30_000, "ab cd " * 20_000, "".join(chr(97 + i % 26) for i in range(5000)), " " * 3000, None, "",
        swapped, swapped.translate(str.maketrans("ab", "ba")), "=" * 777 + SPECIAL + "\n" * 5,
    ]
    for _ in range(2):
        assert ids_of(small, texts) == expected(library, texts)


def test_invalid_bytes_decode_like_the_library(library):
    ids = library.encode("漢字 🙂", add_special_tokens=False).ids
    back = forced_bpe.Decoder(PATH)
    for cut in range(len(ids) + 1):
        assert back.decode(np.array(ids[:cut], np.int64)) == library.decode(ids[:cut], skip_special_tokens=False)


def test_query_over_whole_documents(spark, sf, library):
    got = {r.doc_id: tuple(r)[1:] for r in registry.op12_forced_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)]
        assert got[r.doc_id] == (len(ids), *hashes)


def test_null_repeated_and_missing_rows(spark):
    show_package(spark)
    docs = spark.createDataFrame(
        [(None, "a b", 1), (1, None, 2), (1, "a b", 3), (1, "a b", 3)], "doc_id long, text string, ids int"
    )
    rows = forced_bpe.digests(forced_bpe.decode(forced_bpe.encode(docs, PATH), PATH)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 2), (1, 0), (1, 2), (1, 2)]
    assert sorted(rows, key=str) == sorted(forced_bpe.digests(forced_bpe.encode_decode(docs, PATH)).collect(), key=str)
    assert forced_bpe.encode_decode(docs.limit(0), PATH).count() == 0
