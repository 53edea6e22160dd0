"""Tasks that fail after part of their output: every operator gives what it gives without."""

import json

import public_tokenizers
import pytest
from pyspark import TaskContext

from tierwell.llm import imatch, licenses, mixing, outliers, packing, pieces, quality, repair, runs, simhash, substrings, toxicity
from tierwell.llm.queries import piece_model

FOLDER = "/root/testdata/sf0.001"


def failing(df):
    """The rows of ``df``; every third task passes them on and then fails in its first attempt."""

    def run(batches):
        task = TaskContext.get()
        for batch in batches:
            yield batch
            if task.attemptNumber() == 0 and task.partitionId() % 3 == 0:
                raise RuntimeError("lost")

    return df.mapInArrow(run, df.schema)


def whole(df):
    return sorted(json.dumps(r.asDict(True), sort_keys=True, default=str) for r in df.collect())


def tokenizer():
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    return lambda: packing.words_of(path)


OPERATORS = {
    "toxicity": lambda docs, labels: toxicity.scored(docs, labels),
    "imatch": lambda docs, labels: imatch.compared(docs),
    "pieces": lambda docs, labels: pieces.encoded(docs, pieces.read_model(piece_model()), ["ids_sha256", "spans_sha256"]),
    "licenses": lambda docs, labels: licenses.scanned(docs),
    "mixing": lambda docs, labels: mixing.mixed(docs),
    "simhash": lambda docs, labels: simhash.without_near_copies(docs),
    "quality": lambda docs, labels: quality.accepted(docs, labels),
    "substrings": lambda docs, labels: substrings.kept_texts(docs),
    "outliers": lambda docs, labels: outliers.judged(docs).select("doc_id", "base_failed", "kept"),
    "runs": lambda docs, labels: runs.described(docs, runs.repeated_tail),
    "packing": lambda docs, labels: packing.packed(docs, tokenizer()),
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(6).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).repartition(6, "doc_id")


@pytest.mark.parametrize("name", OPERATORS)
def test_documents(spark, stored, labels, name):
    expected = whole(OPERATORS[name](stored, labels))
    assert whole(OPERATORS[name](failing(stored), labels)) == expected and expected


def test_conversations(spark):
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet").repartition(6)
    expected = whole(repair.conversations_repaired(repair.damaged(turns)))
    assert whole(repair.conversations_repaired(repair.damaged(failing(turns)))) == expected and expected
