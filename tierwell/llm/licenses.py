"""License scan: a set-similarity join of text windows with license templates, by containment.

A window is `BLOCK` consecutive words, or twice the template's words if those are more; one starts
at every word, so a match doesn't depend on where the text stands. A window matches a template if
it has at least the threshold's share of the template's distinct tokens. Candidates come from a
prefix filter: tokens are put in one global order, the rarest in the whole corpus first; a window
that reaches the threshold must have one of the template's first |T| - ceil(t|T|) + 1 tokens.
Windows around such tokens are taken together: the length filter drops them if they hold too few
tokens, the positional filter if those behind the first common one can't reach the threshold. The
rest are compared in full, with counts that run along the template's words. Phrases are templates
with threshold 1 whose words, in addition, must stand consecutively.

The templates are a parameter and few: they and their token counts go to every task; `TEMPLATES`
bounds what is sent. Texts are never shuffled.

Cases: a null text has no words. Repeated rows are repeated in the result; an empty table gives an
empty result; other columns aren't read. A token that the corpus doesn't have is the rarest.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell.llm.common import per_batch

BLOCK = 32
THRESHOLD = 0.9
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# Phrases and their labels.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# License statements and their labels.
TEMPLATES = (
    ("agpl-3.0", "licensed under the gnu affero general public license version 3"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
)


@dataclass
class Template:
    label: str
    words: list[bytes]
    threshold: float
    phrase: bool

    def __post_init__(self):
        self.tokens = set(self.words)
        self.need = ceil(self.threshold * len(self.tokens) - 1e-9)
        self.window = max(BLOCK, 2 * len(self.words))


def templates(phrases=PHRASES, statements=TEMPLATES, threshold: float = THRESHOLD) -> list[Template]:
    made = [Template(label, text.encode().split(), 1.0, True) for label, text in phrases]
    return made + [Template(label, text.encode().split(), threshold, False) for label, text in statements]


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def token_counts(docs: DataFrame, found: list[Template]) -> dict[bytes, int]:
    """How often each token of the templates stands in the corpus: one row a token."""
    wanted = set().union(*(t.tokens for t in found))

    def make():
        def work(texts):
            counts = Counter(w for t in texts for w in words_of(t) if w in wanted)
            return {"token": list(counts), "n": list(counts.values())}

        return work

    made = per_batch(docs.select("text"), "token binary, n long", make)
    return {bytes(r.token): r.n for r in made.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class Index:
    """The inverted index of the templates' prefixes under the global order of tokens."""

    def __init__(self, found: list[Template], counts: dict[bytes, int]):
        tokens = set().union(*(t.tokens for t in found))
        self.order = {w: k for k, w in enumerate(sorted(tokens, key=lambda w: (counts.get(w, 0), w)))}
        self.templates = found
        self.ranked = [sorted(t.tokens, key=self.order.get) for t in found]
        self.prefix = defaultdict(list)
        for number, (t, ranked) in enumerate(zip(found, self.ranked, strict=True)):
            for token in ranked[: len(ranked) - t.need + 1]:
                self.prefix[token].append(number)

    def matches(self, words: list[bytes]):
        """(template, start, last start, containment): phrases at their first word, statements for each
        run of windows that match."""
        known, near = [], defaultdict(list)
        for at, token in enumerate(words):
            if token not in self.order:
                continue
            known.append((at, token))
            for number in self.prefix.get(token, ()):
                t = self.templates[number]
                if not t.phrase:
                    near[number].append(at)
                    continue
                for k, word in enumerate(t.words):
                    start = at - k
                    if word == token and start >= 0 and words[start : start + len(t.words)] == t.words:
                        yield number, start, start, 1.0
        for number, places in near.items():
            t, ranges = self.templates[number], []
            end = max(len(words) - t.window, 0)
            for at in places:
                first, last = max(at - t.window + 1, 0), min(at, end)
                if ranges and first <= ranges[-1][1] + 1:
                    ranges[-1][1] = last
                else:
                    ranges.append([first, last])
            for first, last in ranges:
                inside = known[bisect_left(known, (first,)) : bisect_left(known, (last + t.window,))]
                if self.possible(number, {w for _, w in inside}):
                    for start, stop, common in runs(t, first, last, inside):
                        yield number, start, stop, common / len(t.tokens)

    def possible(self, number: int, held: set[bytes]) -> bool:
        """Whether windows with the known tokens ``held`` pass the length and the positional filter."""
        t, ranked = self.templates[number], self.ranked[number]
        if len(held) < t.need:  # tokens in no template rank before all others
            return False
        place = next(k for k, w in enumerate(ranked) if w in held)
        behind = sum(self.order[w] > self.order[ranked[place]] for w in held)
        return 1 + min(len(ranked) - place - 1, behind) >= t.need


def runs(t: Template, first: int, last: int, inside: list[tuple[int, bytes]]):
    """(start, last start, most common tokens) of windows in a row that match, of those that start from
    ``first`` to ``last``; ``inside`` are the places of tokens."""
    changes = [(max(at - t.window + 1, first), 1, w) for at, w in inside if w in t.tokens]
    changes = sorted(changes + [(at + 1, -1, w) for at, w in inside if w in t.tokens])
    counts, common, run = Counter(), 0, None
    for k, (start, by, token) in enumerate(changes):
        if start > last:
            break
        counts[token] += by
        if counts[token] == (1 if by > 0 else 0):
            common += by
        after = min(changes[k + 1][0], last + 1) if k + 1 < len(changes) else last + 1
        if after == start or common < t.need:
            continue
        if run and run[1] == start - 1:
            run = run[0], after - 1, max(run[2], common)
        else:
            if run:
                yield run
            run = start, after - 1, common
    if run:
        yield run


def scanned(docs: DataFrame, found: list[Template] | None = None) -> DataFrame:
    """One row a document: doc_id, n_words, places of phrases, labels and score.

    The score is the best containment of a template that matches, 0 without one."""
    found = found or templates()
    index = Index(found, token_counts(docs, found))

    def make():
        def work(ids, texts):
            names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
            out = {"doc_id": ids} | {n: [] for n in names}
            for text in texts:
                words = words_of(text)
                hits = list(index.matches(words))
                starts = [s for k, s, _, _ in hits if found[k].phrase]
                base = {found[k].label for k, *_ in hits if found[k].phrase}
                row = (
                    len(words),
                    len(starts),
                    min(starts, default=None),
                    max(starts, default=None),
                    ",".join(sorted(base)),
                    ",".join(sorted({found[k].label for k, *_ in hits})),
                    max((c for *_, c in hits), default=0.0),
                )
                for name, value in zip(names, row, strict=True):
                    out[name].append(value)
            return out

        return work

    return per_batch(
        docs.select("doc_id", "text"),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
        make,
    )


def block_matches(docs: DataFrame, found: list[Template] | None = None) -> DataFrame:
    """doc_id, label, phrase, start and last (words from 0) and containment of every match: of a statement
    the first and last start of windows in a row that match, and the best of them."""
    found = found or templates()
    index = Index(found, token_counts(docs, found))

    def make():
        def work(ids, texts):
            out = {"doc_id": [], "label": [], "phrase": [], "start": [], "last": [], "containment": []}
            for i, text in zip(ids, texts, strict=True):
                for k, start, last, share in index.matches(words_of(text)):
                    row = (i, found[k].label, found[k].phrase, start, last, share)
                    for name, value in zip(out, row, strict=True):
                        out[name].append(value)
            return out

        return work

    return per_batch(
        docs.select("doc_id", "text"),
        "doc_id long, label string, phrase boolean, start long, last long, containment double",
        make,
    )
