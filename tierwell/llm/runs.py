"""Runs: maximal stretches of a text's words that repeat with a period, from Lyndon roots.

The first phase of Baier's suffix sorter groups the suffixes by their longest Lyndon prefixes: groups
of equal first words to begin with, taken from the greatest down; each suffix of the group taken
lengthens the prefix of the nearest suffix before it in a lower group. The lengths are the Lyndon
array. Done under the order of the words and under its reverse, every run has a place in it whose
longest Lyndon word, under one of the two, is as long as the run's period: the run's Lyndon root. Each
root is extended to both sides by the longest common extension with its next occurrence, from
ranks of stretches of 1, 2, 4, ... words, and is a run if that gives two periods.

A run of `least` words is at least half covered by stretches of least / 2 words that stand one period
further on too. Words in no such repeated stretch are in no run; what is left is searched, many
texts at a time, parted by marks less than every word.

Cases: a null or blank text has no words and no run. A null doc_id is carried; the query's
repetition leaves its text alone. Repeated rows are repeated in the result, texts of any length are
searched whole, extra columns are not read, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from tierwell.llm.common import per_batch
from tierwell.llm.substrings import grams, mixed

LEAST = 12
#: Words searched at a time, or those of a longer text.
AT_ONCE = 65_536


def lyndon_array(ranks: list[int], kinds: int) -> list[int]:
    """The length of the longest Lyndon word that starts at each place of ``ranks`` (0 to kinds - 1);
    the end is less than every rank."""
    group = list(ranks)
    members: list[list[int]] = [[] for _ in range(kinds)]
    for i, rank in enumerate(ranks):
        members[rank].append(i)
    length = [1] * kinds
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))
    before, done, found = [-1] * len(ranks), bytearray(len(ranks)), [0] * len(ranks)
    now = kinds - 1
    while now >= 0:
        size, times = length[now], {}
        for i in members[now]:
            if group[i] != now:
                continue
            found[i] = size
            j = i - 1
            while j >= 0 and done[j]:
                j = before[j]
            before[i] = j
            done[i] = 1
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, k in times.items():
            moved.setdefault((group[j], k), []).append(j)
        top: dict[int, int] = {}
        for old, k in sorted(moved) if len(moved) > 1 else moved:
            new, under = len(members), top.get(old, old)
            members.append(moved[old, k])
            length.append(length[old] + k * size)
            below.append(under)
            above.append(above[under])
            below[above[under]] = new
            above[under] = top[old] = new
            for j in moved[old, k]:
                group[j] = new
        now = below[now]
    return found


def stretch_ranks(values: np.ndarray, longest: int) -> list[np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... values that start at each place, up to ``longest``."""
    ranks, span = [np.unique(values, return_inverse=True)[1]], 1
    while 2 * span <= longest:
        last = ranks[-1]
        if len(last) and last.max() + 1 == len(last):
            break
        pairs = last[:-span] * (int(last.max(initial=0)) + 1) + last[span:]
        ranks.append(np.unique(pairs, return_inverse=True)[1])
        span *= 2
    return ranks


def extended(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many values from ``a`` on equal those from ``b`` on; if not forward, those before them."""
    total, n = np.zeros(len(a), np.int64), len(ranks[0])
    for k in range(len(ranks) - 1, -1, -1):
        span, table = 1 << k, ranks[k]
        at, other = (a + total, b + total) if forward else (a - total - span, b - total - span)
        inside = (other + span <= n) if forward else (at >= 0)
        same = table[np.where(inside, at, 0)] == table[np.where(inside, other, 0)]
        total += np.where(inside & same, span, 0)
    return total


def runs_in(pieces: list[np.ndarray], least: int) -> list[np.ndarray]:
    """For each piece its runs of ``least`` values or more: rows (start, length, period), in order of
    start and period."""
    starts = np.cumsum([0, *[len(p) + 1 for p in pieces]])
    marks = starts[1:] - 1
    words = np.concatenate([np.append(p, -1) for p in pieces])
    is_word = words >= 0
    ranks = np.zeros(len(words), np.int64)
    kinds, place = np.unique(words[is_word], return_inverse=True)
    ranks[is_word] = place + 1
    reverse = np.where(is_word, len(kinds) + 1 - ranks, 0)
    roots = [np.array(lyndon_array(r.tolist(), len(kinds) + 1)) for r in (ranks, reverse)]
    at = np.flatnonzero(is_word)
    found = np.unique(np.concatenate([np.stack([at, r[at]]) for r in roots], axis=1), axis=1)
    at, period = found
    # Marks differ from one another, so no stretch goes over one.
    apart = ranks.copy()
    apart[marks] = -1 - np.arange(len(marks))
    table = stretch_ranks(apart, max(map(len, pieces)))
    inside = at + period < len(words)
    at, period = at[inside], period[inside]
    left = extended(table, at, at + period, forward=False)
    right = extended(table, at, at + period, forward=True)
    length = left + right + period
    good = length >= np.maximum(least, 2 * period)
    made = np.unique(np.stack([at - left, length, period])[:, good], axis=1)
    order = np.lexsort((made[2], made[0]))
    made = made[:, order].T
    cuts = np.searchsorted(made[:, 0], starts)
    return [
        made[a:b] - np.array([start, 0, 0])
        for a, b, start in zip(cuts, cuts[1:], starts, strict=False)
    ]


def repeated_stretches(values: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Where stretches of ``size`` values that stand at two places or more cover the text: (from, to).
    Equal hashes may cover too much, never too little."""
    if len(values) < 2 * size:
        return []
    hashes = grams(mixed(values.astype(np.uint64) + np.uint64(1)), size)
    order = np.argsort(hashes, kind="stable")
    equal = hashes[order][1:] == hashes[order][:-1]
    again = np.zeros(len(hashes), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    places = np.flatnonzero(again)
    if not len(places):
        return []
    new = np.flatnonzero(np.diff(places) > size) + 1
    firsts, lasts = places[np.append(0, new)], places[np.append(new - 1, len(places) - 1)]
    return [(a, b + size) for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True)]


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def runs_of_texts(texts: list[list[bytes] | None], least: int = LEAST) -> list[np.ndarray]:
    """The runs of each list of words: rows (start, length, period)."""
    none = np.empty((0, 3), np.int64)
    found = [none] * len(texts)
    waiting: list[tuple[int, int, np.ndarray]] = []

    def search():
        for (k, start, _), own in zip(waiting, runs_in([w[2] for w in waiting], least), strict=True):
            found[k] = np.concatenate([found[k], own + np.array([start, 0, 0])])
        waiting.clear()

    held = 0
    for k, words in enumerate(texts):
        values = numbered(words or [])
        for start, stop in repeated_stretches(values, max(1, least // 2)):
            if stop - start >= least:
                waiting.append((k, start, values[start:stop]))
                held += stop - start
        if held >= AT_ONCE:
            search()
            held = 0
    if waiting:
        search()
    return found


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, from some place on repeated with a period, as chosen by the doc_id's checksum: one
    text in ten. Fixed rule of the check query."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + list(chain.from_iterable([words[a : a + p]] * ((n - a) // p + 1)))[: n - a]


SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long"
)


def described(
    docs: DataFrame,
    change: Callable[[int | None, list[bytes]], list[bytes]] = lambda _, words: words,
    least: int = LEAST,
) -> DataFrame:
    """Per row the number of runs, the longest (ties: first start, then period) and its exponent,
    digests of all runs and of the words left when each run keeps its first period only.

    ``change`` gives the words to search in place of a text's own."""

    def make():
        def work(ids, texts):
            out = {name.split()[0]: [] for name in SCHEMA.split(", ")}
            words = [change(i, (t or "").encode().split()) for i, t in zip(ids, texts, strict=True)]
            for doc_id, own, runs in zip(ids, words, runs_of_texts(words, least), strict=True):
                kept = own
                if len(runs):
                    edge = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
                    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
                    kept = [own[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                lines = "".join([f"{s},{n},{p}\n" for s, n, p in runs.tolist()])
                best = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist() if len(runs) else [None] * 3
                out["doc_id"].append(doc_id)
                out["n_runs"].append(len(runs))
                for name, value in zip(("start", "length", "period"), best, strict=True):
                    out[name].append(value)
                out["exponent_milli"].append(1000 * best[1] // best[2] if len(runs) else None)
                out["runs_sha256"].append(hashlib.sha256(lines.encode()).hexdigest())
                out["collapsed_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
                out["n_words"].append(len(own))
                out["n_dropped"].append(len(own) - len(kept))
            return out

        return work

    return per_batch(docs.select("doc_id", "text"), SCHEMA, make)
