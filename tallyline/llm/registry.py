"""Registered queries of the text operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import byte_bpe, chat_format, conversation_trie, forced_bpe, hamming_search, itq_dedup, lm_difference, ngram_join, ordinal_quality, pii_spans, source_mix, term_pipeline, token_output
from tallyline.llm.storage import stored, table


OP10 = """
WITH usable AS (
  SELECT DISTINCT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, e.vec_id AS neighbor_id,
    CAST(len(list_filter(list_zip(q.embedding, e.embedding), lambda p: (p[1] > 0) <> (p[2] > 0))) AS INTEGER) AS distance
  FROM usable q JOIN usable e ON q.vec_id % 20 = 0 AND e.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pairs)
WHERE rank <= 10
"""


# Components by spreading the smallest id along links.
OP1 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 75 * (p.n + q.n - k)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
FROM words w LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x) USING (doc_id)
"""


# The score is the contract's; rows of documents with one id are documents of their own.
OP11 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
held AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY r),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
factors AS (SELECT r, 100 - 75 + (75 * n * docs) // terms AS m FROM lengths, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, totals GROUP BY term, docs),
asked AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT item_id, r, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN factors USING (r) GROUP BY ALL),
ranked AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


# CRC-32 of decimal ids by its polynomial; a node is named by its turns' digests, its ancestors by its smallest member.
OP13 = """
WITH turns AS (
  SELECT conv_id AS c, turn, length(coalesce(text, '')) AS n,
    md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(k ORDER BY turn NULLS FIRST, k) AS p, list(n ORDER BY turn NULLS FIRST, k) AS n,
    xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda u, v: xor(u >> 1, (u & 1) * 3988292384)))) % 6 AS h
  FROM turns GROUP BY c),
whole AS (
  SELECT o.c, list_concat(coalesce(b.p[1:o.h], []), o.p[o.h + 1:]) AS p,
    list_concat(coalesce(b.n[1:o.h], []), o.n[o.h + 1:]) AS n
  FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 100),
steps AS (
  SELECT c, d, array_to_string(p[1:d], '') AS node, array_to_string(p[1:d - 1], '') AS parent,
    CASE WHEN d = 0 THEN 0 ELSE n[d] END AS chars, d = len(p) AS ends
  FROM whole, unnest(range(0, len(p) + 1)) AS r(d)),
nodes AS (
  SELECT node, d, min(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM steps GROUP BY node, d),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
known AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (node)),
sums AS (
  SELECT s.node, CAST(count(*) FILTER (k.n_children = 0) AS BIGINT) AS n_leaves,
    CAST(sum((k.n_convs - 1) * k.chars) AS BIGINT) AS saved_tokens
  FROM known k JOIN steps s ON s.c = k.conv_id AND s.d <= k.d GROUP BY s.node)
SELECT k.conv_id, k.d AS depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, k.ends_sha256
FROM known k JOIN sums USING (node) LEFT JOIN nodes up ON k.d > 0 AND up.node = k.parent
"""


def _escaped(column: str) -> str:
    sql = rf"replace({column}, '\', '\\')"
    for c in chat_format.CONTROL:
        sql = rf"replace({sql}, '{c}', '{c[0]}\{c[1:]}')"
    return sql


_MARKS = sum(map(len, (chat_format.TURN, chat_format.BODY, chat_format.END)))
OP3 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (SELECT *, length({_escaped('role')}) + length({_escaped('text')}) + {_MARKS} AS chars FROM turns)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY 1
"""


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op1_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of links, and component, of all documents, from every link."""
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as Huffman coded token files, then read back."""
    files = token_output.write_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
        vocabulary=49_408,
    )
    return token_output.read_tokens(spark, files.path).drop("ids")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds control strings, formatted, stored and read back."""
    text = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], rows.schema)
    messages = rows.unionByName(extra).withColumn("parts", chat_format.text_parts(F.col("text")))
    return chat_format.digests(stored(chat_format.format_turns(messages), "chat"))


def op4_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii_spans.summarise(pii_spans.find(table(spark, sf_dir, "documents")))


def op5_lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored between well-rated documents and all documents."""
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return lm_difference.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources takes from each document."""
    return source_mix.taken_words(*source_mix.mix(table(spark, sf_dir, "documents")))


def op7_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, and the probability of the best grade, of all documents."""
    docs = table(spark, sf_dir, "documents")
    model = ordinal_quality.train(docs, ordinal_quality.label_grades(table(spark, sf_dir, "labels")))
    return ordinal_quality.score(docs, model, tail=2)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by byte-level BPE ranks and decoded again."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.encode_decode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


def op9_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all vectors."""
    return itq_dedup.deduplicate(table(spark, sf_dir, "embeddings"))


def op10_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every vector whose id is divisible by 20."""
    return hamming_search.top_k(table(spark, sf_dir, "embeddings"))


def op11_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return term_pipeline.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by a byte-level tokenizer file and decoded again."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return forced_bpe.digests(forced_bpe.encode_decode(table(spark, sf_dir, "documents"), path))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt on shared heads."""
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op1_ngram_links": op1_ngram_links,
        "op2_token_files": op2_token_files,
        "op3_chat_format": op3_chat_format,
        "op4_pii_spans": op4_pii_spans,
        "op5_lm_difference": op5_lm_difference,
        "op6_source_mix": op6_source_mix,
        "op7_quality_grades": op7_quality_grades,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_itq_dedup": op9_itq_dedup,
        "op10_hamming_top_k": op10_hamming_top_k,
        "op11_term_pipeline": op11_term_pipeline,
        "op12_forced_bpe": op12_forced_bpe,
        "op13_conversation_trie": op13_conversation_trie,
    }


def all_oracles() -> dict[str, str]:
    return {"op1_ngram_join": OP1, "op3_chat_format": OP3, "op10_hamming_top_k": OP10, "op11_term_pipeline": OP11, "op13_conversation_trie": OP13}
