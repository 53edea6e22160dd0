"""Runs against every period tried in turn."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierwell.llm import queries, runs


def brute_runs(words, least=12):
    """All periods, smallest first: a stretch that a smaller period already has is not a run of this one."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                inner = any(s <= i and i + (j - i + q) <= s + m and q % p == 0 for s, m, p in found)
                if not inner:
                    found.append((i, j - i + q, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {k for s, m, p in found for k in range(s + p, s + m)}
    kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in found).encode()
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def brute_lyndon(ranks):
    n = len(ranks)
    return [next((j - i for j in range(i + 1, n) if ranks[j:] < ranks[i:]), n - i) for i in range(n)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_phase_one_gives_the_lyndon_array(ranks):
    assert runs.lyndon_array(ranks, 4) == brute_lyndon(ranks)


@pytest.mark.parametrize("least", [2, 3, 12])
def test_all_runs_of_random_words(least):
    rng = random.Random(least)
    texts = []
    for _ in range(400):
        n = rng.randrange(0, 70)
        base = [rng.choice("abc"[: rng.randrange(1, 4)]).encode() for _ in range(n)]
        if n and rng.random() < 0.5:
            base = (base[: rng.randrange(1, 9)] * 20)[: rng.randrange(1, 60)] + base[: rng.randrange(0, 9)]
        texts.append(base)
    made = runs.runs_of_texts(texts, least)
    for text, own in zip(texts, made, strict=True):
        assert [tuple(r) for r in own.tolist()] == brute_runs(text, least), text


def test_words_of_fibonacci_and_thue_morse():
    fib, last = b"a", b"b"
    while len(fib) < 2000:
        fib, last = fib + last, fib
    morse = bytes(97 + (k.bit_count() & 1) for k in range(1024))
    for text in (fib[:600], morse):
        words = [bytes([c]) for c in text]
        (made,) = runs.runs_of_texts([words], 2)
        assert [tuple(r) for r in made.tolist()] == brute_runs(words, 2)


def test_long_texts_take_linear_work():
    words = [b"w%d" % (k % 3) for k in range(200_000)] + [b"x"] * 100_000
    (made,) = runs.runs_of_texts([words])
    assert made.tolist() == [[0, 200_000, 3], [200_000, 100_000, 1]]


def test_query_against_brute_force(spark, folder, rows):
    made = queries.op11_runs(spark, folder)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert made.columns[:8] == columns
    short = [r for r in rows if len(r[1] or "") < 60_000]
    got = {}
    for r in made.collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[:8])
    for r in short:
        if [x[0] for x in rows].count(r[0]) == 1:
            assert got[r[0]] == [brute_row(r[0], r[1])]
    assert sum(map(len, got.values())) == len(rows)
    assert any(r[0][1] for r in got.values())


def test_edge_cases(spark, docs, empty):
    assert runs.described(empty).collect() == []
    plain = runs.described(docs)
    assert plain.count() == docs.count()
    rows = [(None, "a " * 30), (1, None), (2, " \n\t"), (3, "a b " * 5), (4, "a b " * 6 + "a")]
    made = runs.described(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.n_runs, r.start, r.length, r.period) for r in made] == [
        (1, 0, 30, 1), (0, None, None, None), (0, None, None, None), (0, None, None, None), (1, 0, 13, 2)
    ]
    assert np.isclose(made[0].exponent_milli, 30_000)
