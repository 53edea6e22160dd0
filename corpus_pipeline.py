"""A corpus from documents to tokens, in five stages of the llm operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwell.llm import mixing, pieces, quality, simhash, substrings
from tierwell.llm.common import documents, labels, stable
from tierwell.llm.queries import piece_model


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.accepted(docs, labels(spark, sf_dir), threshold=0.3)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near copies."""
    return simhash.without_near_copies(docs, shingle=3, bits=2)


def fresh_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the words of passages that an earlier document has."""
    return substrings.kept_texts(docs)


def weighted_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents until each source has its share of the words."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the token ids of the text with the bytes of the text that each spans, and digests
    of the ids and of the decoded text."""
    wanted = ["n_tokens", "ids", "begins", "ends", "ids_sha256", "decoded_sha256"]
    return pieces.encoded(docs, pieces.read_model(piece_model()), wanted, keep=("doc_id", "source"))


STAGES = [
    ("quality classifier", good_documents),
    ("simhash near-dedup", distinct_documents),
    ("substring dedup", fresh_passages),
    ("mixing sources to target weights", weighted_mix),
    ("sentencepiece encoding", token_ids),
]

#: Training, hashing with a seed and merging pieces have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
