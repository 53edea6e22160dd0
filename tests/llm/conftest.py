import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_rows():
    """Nulls in any column, blank and long texts, ties, repeated rows, near copies, odd characters."""
    long_text = " ".join(f"word{k % 977}x{k % 13}" for k in range(30_000))
    passage = " ".join(f"pass{k}" for k in range(70))
    rows = [
        (100_000, None, "en", "src0", None),
        (100_001, "", None, None, 0),
        (100_002, " \t\n\x0b\f\r ", "de", None, 7),
        (100_003, long_text, "en", "src0", len(long_text)),
        (100_004, "x" * 5000, "en", "src1", 5000),
        (100_005, "Same text here", "en", "src1", 14),
        (100_005, "Same text here", "en", "src1", 14),
        (100_006, "Same text here", "fr", "src1", 14),
        (None, "No id at all but text", "en", "src2", 21),
        (None, "No id " + passage, None, None, None),
        (100_007, "a b " + passage + " c", "en", "src2", None),
        (100_008, passage, "en", "src2", None),
        (100_009, "q " + passage + " " + passage + " r s", "en", "src2", None),
        (100_010, "▁ weird  ▁▁ <s> </s>  nbsp é 日本 🤗\x00   end\n\n", "fr", "Ŝrc", 40),
        (100_011, "Licensed under CC-BY-NC 4.0. All rights   reserved. all rights reserved", "en", "z", 1),
        (100_012, "this work is licensed under GNU General Public License version 3 cc by cc by", "en", "z", 1),
        (-5, "one two three four", "en", "src0", 18),
        (100_013, "AbC! #*$%&|<> abc\nabc\nabc\n\nabc d e abc d e", "en", "src0", 44),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    table = pq.read_table(f"{FOLDER}/documents.parquet")
    own = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "text", "lang", "source", "n_chars")), strict=True))
    return own + edge_rows()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The rows in several files, with extra columns whose names the operators use inside."""
    path = str(tmp_path_factory.mktemp("docs"))
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "0 AS row_key", "'x' AS fingerprint", "1 AS n", "2 AS rest", "3 AS a")
    df.repartition(5).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="session")
def folder(spark, docs, labels, tmp_path_factory):
    """A table folder with the fixture's documents."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return path
