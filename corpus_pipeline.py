"""The corpus pipeline: stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Each works on everything that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import byte_bpe, ngram_join, ordinal_quality, pii_spans, source_mix
from tallyline.llm.storage import show_package, stored, table


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that probably have the best grade; the rest go."""
    show_package(spark)
    ratings = ordinal_quality.label_grades(table(spark, sf_dir, "labels"))
    return ordinal_quality.keep(docs, ordinal_quality.train(docs, ratings), tail=2)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest id; documents without words stay."""
    show_package(spark)
    return ngram_join.drop_duplicates(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; `n_chars` follows the text."""
    found = stored(pii_spans.candidates(docs.select("text")).select("candidates"), "pii")
    redacted = pii_spans.redact(docs, pii_spans.train(found))
    kind = docs.schema["n_chars"].dataType
    return redacted.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in proportion to the weights of their sources, repeated up to three times."""
    return source_mix.mixed_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of each document of the mix; the digest is of the decoded bytes."""
    show_package(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", select_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_tokens),
]

# SQL can express neither the classifier nor the draw.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
