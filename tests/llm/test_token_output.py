"""Huffman token files against the tokenizer library."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyline.llm import huffman, registry, token_output, word_ids
from tallyline.llm.storage import show_package
from tallyline.llm.text_arrays import text_bytes

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None,
    "",
    " \t\n",
    "Hello, it's 42 o'clock!",
    "É́ İstanbul ß ﬁ ² Ⅷ 漢字 x y <|endoftext|> 🙂",
    "a" * 5000,
    "word " * 4000,
    "Hello, it's 42 o'clock!",
]


def expected(rows):
    tool = Tokenizer.from_file(PATH)
    tool.encode_special_tokens = True
    out, start = {}, 0
    for doc_id, text in sorted(rows):
        ids = np.array([*tool.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_round_trip_of_odd_texts(spark, tmp_path):
    show_package(spark)
    rows = [(10 - i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, shard int")
    files = token_output.write_tokens(docs, PATH, 2, 49_408, path=str(tmp_path / "files"))
    for source in (files, str(tmp_path / "files")):  # the folder alone is enough
        got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_output.read_tokens(spark, source).collect()}
        assert got == expected(rows)
    again = token_output.open_tokens(spark, str(tmp_path / "files"))
    assert again.limit == files.limit and (again.lengths == files.lengths).all()


def test_null_and_repeated_ids_are_rows_of_their_own(spark, tmp_path):
    docs = spark.createDataFrame([(None, "b"), (3, "c"), (3, "a"), (3, "a")], "doc_id long, text string")
    files = token_output.write_tokens(docs, PATH, 2, 49_408, path=str(tmp_path / "files"))
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_output.read_tokens(spark, files).collect())
    assert [x[1] for x in got] == [None, 3, 3, 3]
    assert [x[0] for x in got] == [0, 2, 4, 6]


def test_an_empty_table_gives_none(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    files = token_output.write_tokens(docs, PATH, 2, 49_408, path=str(tmp_path / "files"))
    assert token_output.read_tokens(spark, files).count() == 0


def test_query_over_whole_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in registry.op2_token_files(spark, sf).collect()}
    assert got == expected(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=300), st.integers(9, 16))
def test_lengths_are_a_complete_code_within_the_limit(counts, limit):
    lengths = huffman.code_lengths(np.array(counts), limit)
    used = lengths[np.array(counts) > 0].astype(float)
    assert (lengths <= limit).all()
    assert ((lengths > 0) == (np.array(counts) > 0)).all()
    if len(used) > 1:
        assert (2.0**-used).sum() == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=3000), st.integers(6, 20))
def test_blocks_decode_to_what_was_encoded(ids, limit):
    ids = np.array(ids, np.int64)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=41), limit)
    counts = np.array([len(ids) // 3, len(ids) - len(ids) // 3])
    begin, size = token_output._block_starts(counts)
    payload, offsets = huffman.encode(ids, begin, huffman.canonical(lengths), lengths)
    back = huffman.decode(payload, offsets, size, huffman.decode_table(lengths, limit), limit)
    assert back.tolist() == ids.tolist()


def test_length_limit_is_optimal_on_a_known_case():
    # Unlimited these weights need 5 bits; within 3 bits the best total is 8 codes of 3 bits or fewer.
    lengths = huffman.code_lengths(np.array([1, 1, 2, 3, 5, 8]), 3)
    assert int((lengths * np.array([1, 1, 2, 3, 5, 8])).sum()) == min(
        sum(w * x for w, x in zip([1, 1, 2, 3, 5, 8], combo, strict=True))
        for combo in ([3, 3, 3, 3, 2, 2], [3, 3, 3, 3, 3, 1])
        if sum(2.0**-x for x in combo) <= 1
    )


def test_too_many_ids_for_the_limit():
    with pytest.raises(ValueError, match="do not fit"):
        huffman.code_lengths(np.ones(9), 3)


def test_words_that_share_a_hash_keep_their_own_ids(monkeypatch):
    one = "a"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    texts = ["same sane", "sane x", None, f"{one} y", one.translate(str.maketrans("ab", "ba"))]
    library = Tokenizer.from_file(PATH)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for hashes in (word_ids.range_hashes, lambda d, a, b: (b - a).astype(np.uint64)):
        monkeypatch.setattr(word_ids, "range_hashes", hashes)
        tool = word_ids.WordEncoder(PATH)
        for _ in range(2):
            ids, firsts = tool.encode(*text_bytes(pa.array(texts, pa.string())))
            assert [ids[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:], strict=True)] == want
