"""Quality classifier: random-indexing word vectors pooled per document, and a small network.

Words are letter runs and symbol runs. Each gets a sparse random index vector from its hash; its
word vector is the sum of the index vectors of its neighbours in the training texts, scaled to
length one. A word out of the vocabulary falls back to a word for its shape (case, length), which
is trained like any other. A document is pooled twice, over its words and over its distinct words,
with the spread of the first: repetition shows in the difference. A network of two layers gives a
logit, and a temperature, fitted on a fifth of the training rows which the network hasn't seen,
makes it a probability.

The classifier is fitted on a bounded sample of the labelled training rows: at most `SAMPLE` of each
label, those with the smallest hashes of doc_id. Their whole texts are read in tasks, which count words, add
up word vectors and pool documents; the driver gets the words that stand there three times or
more, their vectors, a row of numbers for each document, and no text. It fits network and
temperature.

Cases: null and empty texts are scored as documents without words. Null labels and labels without a
document are left out; of a doc_id's repeated rows one is learned from. Without rows of both labels every score is the smoothed share of label 1
(0.5 without any). Repeated rows are repeated in the result; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell.llm.common import ROWS_AT_ONCE, held_out, per_batch, stable

SAMPLE = 1500
DIMENSIONS = 48
NONZERO = 4
#: A word is one of the vocabulary from so many occurrences in the sample on.
COMMON = 3
#: Tasks that read the sample.
READERS = 16
#: Words whose vectors travel together.
BLOCK = 2048
HIDDEN = 24
REACH = 2

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def shape(word: str) -> str:
    """The fallback word of a word's case and length."""
    if not word[0].isalnum():
        return "<symbols %d>" % min(len(word), 4)
    case = "upper" if word.isupper() else "digits" if word.isdigit() else "title" if word[0].isupper() else "lower"
    return "<%s %d>" % (case, min(len(word).bit_length(), 5))


def index_vector(word: str) -> np.ndarray:
    vector = np.zeros(DIMENSIONS, np.float32)
    for k in range(NONZERO):
        h = xxhash.xxh64_intdigest(word, k)
        vector[h % DIMENSIONS] += 1 if h >> 63 else -1
    return vector


@dataclass
class Model:
    """Vocabulary, vectors (a row for each word) and the network; all of bounded size."""

    words: dict[str, int]
    vectors: np.ndarray
    middle: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float] | None
    temperature: float
    base: float

    def ids(self, text: str | None) -> np.ndarray:
        get, out = self.words.get, []
        for word in TOKEN.findall(text or ""):
            k = get(word)
            out.append(get(shape(word), 0) if k is None else k)
        return np.array(out, np.int64)

    def pooled(self, text: str | None) -> np.ndarray:
        ids = self.ids(text)
        if not len(ids):
            return np.zeros(3 * DIMENSIONS + 3, np.float32)
        kinds, counts = np.unique(ids, return_counts=True)
        vectors, share = self.vectors[kinds], (counts / len(ids)).astype(np.float32)
        mean = share @ vectors
        spread = np.sqrt(np.maximum(share @ vectors**2 - mean**2, 0))
        text = text or ""
        words = text.split()
        distinct = len(set(words)) / max(1, len(words))
        chars = len(text) / max(1, len(words))
        return np.concatenate(
            (mean, vectors.mean(axis=0), spread, [distinct, np.log1p(len(words)), np.log1p(chars)])
        ).astype(np.float32)

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh(((x - self.middle) / self.scale) @ a + b) @ c + d

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.layers is None:
            return np.full(len(texts), self.base)
        if not texts:
            return np.empty(0)
        x = np.stack([self.pooled(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40).astype(float)))


def trained_on(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """The bounded sample of labelled training rows: doc_id, mark and whole text, one row for each doc_id
    and label."""
    marks = labels.select(F.col("doc_id").alias("marked"), F.col(label).cast("int").alias("mark"))
    marks = marks.where("mark in (0, 1)").where(~held_out(F.col("marked"))).distinct()
    chosen = []
    for mark in (0, 1):  # the ids first, so that only the chosen texts move
        ids = marks.where(F.col("mark") == mark).orderBy(F.xxhash64("marked"), "marked").limit(sample)
        chosen.append(ids)
    wanted = chosen[0].union(chosen[1])
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(wanted), F.col("doc_id") == F.col("marked"))
    rows = rows.groupBy("doc_id", "mark").agg(F.min("text").alias("text"))  # a doc_id may repeat
    return stable(rows.repartition(READERS, "doc_id").sortWithinPartitions("doc_id", "mark"))


def vocabulary(rows: DataFrame) -> dict[str, int]:
    """The sample's common words and all shapes, numbered: unknown, words by frequency, shapes."""

    def make():
        def work(texts):
            words = Counter(w for t in texts for w in TOKEN.findall(t))
            shapes = Counter(map(shape, words))
            both = [(words, False), (shapes, True)]
            return {
                "word": [w for counts, _ in both for w in counts],
                "n": [n for counts, _ in both for n in counts.values()],
                "is_shape": [kind for counts, kind in both for _ in counts],
            }

        return work

    counts = per_batch(rows.select("text"), "word string, n long, is_shape boolean", make)
    counts = counts.groupBy("word", "is_shape").agg(F.sum("n").alias("n"))
    counts = counts.where(F.col("is_shape") | (F.col("n") >= COMMON))
    found = sorted(map(tuple, counts.collect()), key=lambda r: (r[1], 0 if r[1] else -r[2], r[0]))
    words = {"<unknown>": 0}
    for word, *_ in found:
        words.setdefault(word, len(words))
    return words


def word_vectors(rows: DataFrame, words: dict[str, int]) -> np.ndarray:
    """The words' own index vectors, which keep rare ones apart, and a tenth of those of their neighbours in
    the sample; a shape's neighbours are those before the words that have it."""
    index = np.stack([index_vector(w) for w in words])

    def run(batches):
        total, used = np.zeros_like(index, np.float64), False
        for batch in batches:
            for text in batch.column("text"):
                found = TOKEN.findall(text.as_py())
                ids = np.array([words.get(w, words.get(shape(w), 0)) for w in found], np.int64)
                shapes = np.array([words.get(shape(w), 0) for w in found], np.int64)
                for reach in range(1, REACH + 1):
                    if len(ids) > reach:
                        used = True
                        near = ((ids[:-reach], ids[reach:]), (ids[reach:], ids[:-reach]), (shapes[reach:], ids[:-reach]))
                        for a, b in near:
                            order = np.argsort(a, kind="stable")
                            kinds, starts = np.unique(a[order], return_index=True)
                            total[kinds] += np.add.reduceat(index[b[order]], starts)
        for start in range(0, len(total) if used else 0, BLOCK):
            block = total[start : start + BLOCK].astype(np.int64)
            yield pa.RecordBatch.from_pydict({"start": [start], "vectors": [block.tobytes()]})

    def added(table):
        blocks = (np.frombuffer(v.as_buffer(), np.int64) for v in table.column("vectors"))
        return pa.table({"start": table.column("start")[:1], "vectors": [sum(blocks).tobytes()]})

    vectors = np.zeros(index.shape, np.int64)  # sums of whole numbers, equal in any order
    parts = rows.select("text").mapInArrow(run, "start long, vectors binary").groupBy("start")
    for row in parts.applyInArrow(added, "start long, vectors binary").collect():
        block = np.frombuffer(row.vectors, np.int64).reshape(-1, DIMENSIONS)
        vectors[row.start : row.start + len(block)] = block
    made = index + np.float32(0.1) * vectors.astype(np.float32)
    return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-6)


def pooled_rows(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The sample's marks and pooled documents, in order of doc_id and mark."""

    def make():
        return lambda ids, marks, texts: {
            "doc_id": ids, "mark": marks, "pooled": [model.pooled(t).tobytes() for t in texts]
        }

    found = per_batch(rows.select("doc_id", "mark", "text"), "doc_id long, mark int, pooled binary", make).collect()
    found.sort(key=lambda r: (r.doc_id, r.mark))
    x = [np.frombuffer(r.pooled, np.float32) for r in found]
    return np.array([r.mark for r in found], np.float32), np.stack(x) if x else np.empty((0, 0))


def fit(rows: DataFrame, steps: int = 400, seed: int = 7) -> Model:
    """The model of the sample ``rows`` (of `trained_on`)."""
    n = {r.mark: r.n for r in rows.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = float((n.get(1, 0) + 1) / (sum(n.values()) + 2))
    if len(n) < 2:
        nothing = np.zeros(1, np.float32)
        return Model({}, nothing, nothing, nothing, None, 1.0, base)
    words = vocabulary(rows)
    model = Model(words, word_vectors(rows, words), 0, 1, None, 1.0, base)
    marks, x = pooled_rows(rows, model)
    model.middle, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - model.middle) / model.scale
    random = np.random.default_rng(seed)
    check = random.permutation(len(marks)) % 5 == 0
    if len(set(marks[check].tolist())) < 2 or len(set(marks[~check].tolist())) < 2:
        check = np.zeros(len(marks), bool)
    weight = np.where(marks > 0, 0.5 / marks.mean(), 0.5 / (1 - marks.mean()))
    weights = [
        random.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    zt, yt, wt = z[~check], marks[~check], weight[~check]
    for step in range(1, steps + 1):
        h = np.tanh(zt @ weights[0] + weights[1])
        p = 1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3], -30, 30)))
        e = wt * (p - yt) / len(yt)
        back = np.outer(e, weights[2]) * (1 - h**2)
        grads = [zt.T @ back + 2e-3 * weights[0], back.sum(0), h.T @ e + 2e-3 * weights[2], e.sum(keepdims=True)]
        for k, g in enumerate(grads):  # Adam
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            weights[k] -= 0.02 * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model.layers = (weights[0], weights[1], weights[2], float(weights[3][0]))
    where = check if check.any() else ~check
    logit = model.logits(x[where])
    grid = np.geomspace(0.1, 8, 80)
    loss = [np.mean(weight[where] * np.logaddexp(0, np.where(marks[where] > 0, -logit, logit) / t)) for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    return model


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out and score of each row."""
    model = fit(trained_on(docs, labels, label, sample))

    def make():
        return lambda ids, texts: {"doc_id": ids, "score": model.scores(texts)}

    made = per_batch(docs.select("doc_id", "text"), "doc_id long, score double", make)
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **settings) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold."""
    model = fit(trained_on(docs, labels, "quality", settings.get("sample", SAMPLE)))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(
            np.concatenate(
                [np.empty(0)]
                + [
                    model.scores(texts.iloc[k : k + ROWS_AT_ONCE].tolist())
                    for k in range(0, len(texts), ROWS_AT_ONCE)
                ]
            )
        )

    return docs.where(score("text") >= threshold)
