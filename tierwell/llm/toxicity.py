"""Toxicity by multiple-instance learning: a document is as toxic as its sentences together.

A text is cut into sentences at . ! ? and line ends. A sentence's chance of offence is the logistic
of the sum of its distinct words' weights and a bias, as far as it exceeds the bias's alone; the
document's is the noisy-or of its sentences and of the bias, 1 - (1 - leak) * prod(1 - sentence). So
sentences without evidence add nothing, and a long clean text scores as a short one. Weights are
trained from the labels of documents alone; the scores then say which sentences gave offence.

Features are words and their first `STEM` letters, so that inflected forms count together. Only those
are kept whose share of toxic and of other documents differs by `CONTRAST` standard errors or more.

The model is fitted on a bounded sample of the labelled training rows: at most `SAMPLE` of each label,
those with the smallest hashes of doc_id. Their whole texts are read in tasks; the driver gets the
telling features and their places in sentences, and no text.

Cases: null and empty texts have no sentences; their score is the bias's alone. Null labels and
labels without a document are left out; without both labels every score is the smoothed share of
label 1. Repeated rows are repeated in the result; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell.llm.common import held_out, per_batch
from tierwell.llm.quality import trained_on

SAMPLE = 3000
STEM = 4
CONTRAST = 6.0
#: A sentence from this score on is named.
OFFENDING = 0.5

SCORED = "doc_id long, score double, n_offending int, worst_start int, worst_stop int, worst_score double"

SENTENCE = re.compile(r"[.!?\n]+")
LETTERS = re.compile(r"[^\W\d_]+")


def softplus(x):
    return np.logaddexp(0, x)


def features(words: list[str]) -> set[str]:
    return {*words, *["^" + w[:STEM] for w in words if len(w) > STEM]}


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    fixed: float | None = None

    def logit(self, words: list[str]) -> float:
        known = self.weights.keys() & features(words)
        return self.bias + sum(self.weights[w] for w in sorted(known))

    def evidence(self, words: list[str]) -> float:
        """-log of the chance that a sentence gives no offence, beyond the bias."""
        return max(0.0, float(softplus(self.logit(words)) - softplus(self.bias)))

    def sentences(self, text: str | None) -> list[tuple[int, int, float]]:
        """Start, end and score of each sentence with letters."""
        found, at = [], 0
        text = text or ""
        for cut in [*SENTENCE.finditer(text), None]:
            end = cut.start() if cut else len(text)
            words = LETTERS.findall(text[at:end].lower())
            if words:
                found.append((at, end, float(-np.expm1(-self.evidence(words)))))
            at = cut.end() if cut else end
        return found

    def located(self, text: str | None, least: float) -> tuple[float, list[tuple[int, int, float]]]:
        """The noisy-or of the sentences, and those that give offence."""
        if self.fixed is not None:
            return self.fixed, []
        clean, found = softplus(self.bias), []
        # Texts without any weighted feature, nearly all, need no look at their sentences.
        if not self.weights.keys().isdisjoint(features(LETTERS.findall((text or "").lower()))):
            found = self.sentences(text)
            clean -= sum(np.log1p(-min(score, 1 - 1e-16)) for _, _, score in found)
        return float(-np.expm1(-clean)), [s for s in found if s[2] >= least]

    def score(self, text: str | None) -> float:
        return self.located(text, OFFENDING)[0]


def bag(text: str) -> list[set[str]]:
    """The features of each sentence with letters."""
    found = map(LETTERS.findall, SENTENCE.split(text.lower()))
    return [features(words) for words in found if words]


def telling(rows: DataFrame, ones: int, zeros: int) -> list[str]:
    """The features that set toxic documents of the sample apart, most telling first."""

    def make():
        def work(marks, texts):
            seen = [Counter(), Counter()]
            for mark, text in zip(marks, texts, strict=True):
                seen[mark].update(set().union(*bag(text)))
            found = list(seen[0].keys() | seen[1].keys())
            return {"word": found, "zeros": [seen[0][w] for w in found], "ones": [seen[1][w] for w in found]}

        return work

    counts = per_batch(rows.select("mark", "text"), "word string, zeros long, ones long", make)
    counts = counts.groupBy("word").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    share = (F.col("zeros") + F.col("ones")) / (ones + zeros)
    error = F.sqrt(share * (1 - share) * (1 / ones + 1 / zeros))
    z = F.abs(F.col("ones") / ones - F.col("zeros") / zeros) / F.greatest(error, F.lit(1e-9))
    found = counts.select("word", F.round(z, 9).alias("z")).where(F.col("z") >= CONTRAST)
    return [w for _, w in sorted((-r.z, r.word) for r in found.collect())]


def bags(rows: DataFrame, number: dict[str, int]) -> list[tuple[int, list[list[int]]]]:
    """For each text of the sample its mark and the numbers of the telling features of each sentence."""

    def make():
        def work(ids, marks, texts):
            found = [[sorted(number[w] for w in s if w in number) for s in bag(t)] for t in texts]
            return {"doc_id": ids, "mark": marks, "known": [[s for s in f if s] for f in found],
                    "n_sentences": [len(f) for f in found]}

        return work

    schema = "doc_id long, mark int, known array<array<int>>, n_sentences int"
    found = per_batch(rows.select("doc_id", "mark", "text"), schema, make).collect()
    return [
        (r.mark, [*r.known, *[[]] * (r.n_sentences - len(r.known))])
        for r in sorted(found, key=lambda r: (r.doc_id, r.mark))
    ]


def fit(rows: DataFrame, steps: int = 300) -> Model:
    """Gradient steps on the log likelihood of the noisy-or, with a penalty on the weights, for the sample
    ``rows`` (of `trained_on`). Its texts are read in tasks; the driver gets the telling features and
    which of them each sentence has."""
    n = {r.mark: r.n for r in rows.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return Model(0.0, fixed=float((n.get(1, 0) + 1) / (sum(n.values()) + 2)))
    words = telling(rows, n[1], n[0])
    found = bags(rows, {w: k for k, w in enumerate(words)})
    marks = np.array([m for m, _ in found], np.float64)
    feature, sentence, document = [], [], []
    for k, (_, sentences) in enumerate(found):
        for known in sentences:
            feature += known
            sentence += [len(document)] * len(known)
            document.append(k)
    feature, sentence, document = (np.array(x, np.int64) for x in (feature, sentence, document))
    weights, bias = np.zeros(len(words)), -6.0
    first, second = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    weight = np.where(marks > 0, 0.5 / marks.mean(), 0.5 / (1 - marks.mean()))
    for step in range(1, steps + 1):
        z = bias + np.bincount(sentence, weights[feature], len(document))
        counted = z >= bias  # the others are no evidence
        excess = np.where(counted, softplus(z) - softplus(bias), 0.0)
        clean = softplus(bias) + np.bincount(document, excess, len(found))  # -log(no offence)
        pull = np.where(marks > 0, 1 / np.maximum(np.expm1(np.minimum(clean, 50)), 1e-9), -1.0)
        each, leak = pull * weight / len(found), 1 / (1 + np.exp(-bias))
        push = np.where(counted, each[document] / (1 + np.exp(-z)), 0.0)
        of_bias = push.sum() + leak * (each.sum() - each[document][counted].sum())
        grad = np.append(np.bincount(feature, push[sentence], len(words)) - 1e-4 * weights, of_bias)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        move = 0.1 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights += move[:-1]
        bias = float(np.clip(bias + move[-1], -8.0, -5.0))  # without evidence clean
    return Model(bias, {w: float(x) for w, x in zip(words, weights, strict=True)})


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    return fit(trained_on(docs, labels, label, sample))


def scored(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out and score of each row, how many of its sentences give offence, and place (code
    points) and score of the worst, the first of equals; null without one."""
    model = trained(docs, labels, label, sample)

    def make():
        def work(ids, texts):
            out = {name.split()[0]: [] for name in SCORED.split(", ")} | {"doc_id": ids}
            for text in texts:
                score, found = model.located(text, OFFENDING)
                worst = max(found, key=lambda s: (s[2], -s[0]), default=(None,) * 3)
                out["score"].append(score)
                out["n_offending"].append(len(found))
                for name, value in zip(("worst_start", "worst_stop", "worst_score"), worst, strict=True):
                    out[name].append(value)
            return out

        return work

    made = per_batch(docs.select("doc_id", "text"), SCORED, make)
    return made.withColumn("held_out", held_out(F.col("doc_id"))).select(
        "doc_id", "held_out", "score", "n_offending", "worst_start", "worst_stop", "worst_score"
    )


def offending(docs: DataFrame, model: Model, least: float = OFFENDING) -> DataFrame:
    """doc_id, start and end (code points) and score of each sentence that gives offence."""

    def make():
        def work(ids, texts):
            out = {"doc_id": [], "start": [], "stop": [], "score": []}
            for i, text in zip(ids, texts, strict=True):
                for a, b, score in model.sentences(text) if model.fixed is None else ():
                    if score >= least:
                        for name, value in zip(out, (i, a, b, score), strict=True):
                            out[name].append(value)
            return out

        return work

    return per_batch(
        docs.select("doc_id", "text"), "doc_id long, start int, stop int, score double", make
    )
