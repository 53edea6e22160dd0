"""The check queries of the operators: production parameters, whole tables, contract columns."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwell.llm import (
    imatch,
    licenses,
    mixing,
    outliers,
    packing,
    pieces,
    quality,
    repair,
    runs,
    simhash,
    substrings,
    toxicity,
    toolcalls,
)
from tierwell.llm.common import documents, labels


def piece_model() -> str:
    """The model file of the queries: `piece_bpe_32k.model` among the public tokenizers."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path("piece_bpe_32k.model"))


def word_tokenizer() -> str:
    """The tokenizer of the packing query, among the public tokenizers."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path("word_bpe_49k.json"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = toxicity.scored(documents(spark, sf_dir), labels(spark, sf_dir))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return made.select("doc_id", "held_out", "score", predicted, *made.columns[3:])


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compared(documents(spark, sf_dir))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]
    return pieces.encoded(documents(spark, sf_dir), pieces.read_model(piece_model()), wanted)


def op4_toolcalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    made = toolcalls.records(
        toolcalls.calls_of(turns), toolcalls.results_of(turns), {"ask": toolcalls.ASK}
    )
    return made.drop("call_rank", "call_rows", "result_rank", "result_rows")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    words = mixing.word_count(docs.text).alias("words")
    sized = docs.select("doc_id", "source", words, F.xxhash64("text").alias("text_hash"))
    return mixing.copied(sized, size="words").select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_words").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = simhash.components(documents(spark, sf_dir), shingle=3, bits=2)
    return made.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = quality.scored(documents(spark, sf_dir), labels(spark, sf_dir))
    return made.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_digests(documents(spark, sf_dir))


def op10_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(documents(spark, sf_dir))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.described(documents(spark, sf_dir), runs.repeated_tail)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair.conversations_repaired(repair.damaged(turns))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = word_tokenizer()
    return packing.packed(documents(spark, sf_dir), lambda: packing.words_of(path))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_imatch,
        op3_pieces,
        op4_toolcalls,
        op5_licenses,
        op6_mixing,
        op7_simhash,
        op8_quality,
        op9_substrings,
        op10_outliers,
        op11_runs,
        op12_repair,
        op13_packing,
    )
}

#: Windows of 50 words, written out.
SUBSTRINGS = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    row_number() OVER () AS row_id FROM documents),
windows AS (
  SELECT doc_id, row_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS sequence
  FROM words, unnest(range(1, len(w) - 48)) AS t(i) WHERE len(w) >= 50),
firsts AS (SELECT sequence, min(doc_id) AS first_id FROM windows GROUP BY sequence),
gone AS (
  SELECT DISTINCT row_id, i + k AS place
  FROM windows JOIN firsts USING (sequence), unnest(range(0, 50)) AS u(k) WHERE doc_id > first_id),
kept AS (
  SELECT row_id, string_agg(w[j], ' ' ORDER BY j) AS text, count(*) AS n
  FROM words, unnest(range(1, len(w) + 1)) AS t(j)
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.row_id = words.row_id AND gone.place = j)
  GROUP BY row_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (row_id)
"""

ORACLES: dict[str, str] = {
    "op4_toolcalls": toolcalls.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op9_substrings": SUBSTRINGS,
}
