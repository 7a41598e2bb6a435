"""Raw documents to token ids: language, near duplicates, repeated passages, benchmark passages, encoding.

Each stage takes what its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeledger.llm import bpe, decontaminate, jaccard_join, language, shared, substring


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told with a posterior of one half or more go."""
    return language.accepted(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 20 that occur earlier are cut out of the texts."""
    return substring.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words lie in benchmark windows go."""
    items = shared.read(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "doc_id")
    return decontaminate.clean(docs, items)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of the decoded text."""
    out = bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", encoding),
]

#: SQL expresses neither the language model nor the encoder; the tests hold run() against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last landed in the shared folder."""
    docs = shared.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
