"""Repaired conversations against all edit sequences, each turn in its own right."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tierwell.llm import queries, repair

SPACE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute_edits(turns):
    """(cost, letters, repaired) by trying every edit at every turn; Inserts in a row up to three."""

    def step(state, letter):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, letter))

    @lru_cache(maxsize=None)
    def best(k, state, inserted):
        found = []
        if k == len(turns) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if (after := step(state, role[0])) is not None:
                    cost, letters, made = best(k, after, inserted + 1)
                    found.append((cost + 2, "I" + letters, ((role, ""), *made)))
        if k < len(turns):
            role, text, fault = turns[k]
            cost, letters, made = best(k + 1, state, 0)
            found.append((cost + 3, "D" + letters, made))
            if fault not in ("blank", "duplicate"):
                more = 1 if fault == "truncated" else 0
                if role and (after := step(state, role[0])) is not None:
                    cost, letters, made = best(k + 1, after, 0)
                    found.append((cost + more, "K" + letters, ((role, text), *made)))
                for other in ("user", "assistant"):
                    if (after := step(state, other[0])) is not None:
                        cost, letters, made = best(k + 1, after, 0)
                        found.append((cost + 2 + more, "R" + letters, ((other, text), *made)))
        return min(found, default=(10**9, "", ()))

    return best(0, "", 0)


def brute(rows, damage=True):
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20 if damage else 9
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        own += [(turn is not None, turn or 0, role, digest, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort()
        seen, turns = set(), []
        for _, _, role, _, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            turns.append((role, text, fault))
        numbers = [t for known, t, *_ in own if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        counts = [sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")]
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, letters, made = brute_edits(tuple(turns))
        text = "\n".join(f"{r}:{t}" for r, t in made)
        out.append((conv, gaps, *counts, illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def odd_rows(seed=1, n=120):
    rng = random.Random(seed)
    texts = ["Hi.", "Hi. ", "cut", "cut off\n", "", " \t", None, "What?", "yes!", "…", "é.", "a.b"]
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "ursula", "System"]
    rows = []
    for conv in [*range(n), None, -3]:
        for turn in range(rng.randrange(1, 9)):
            number = None if rng.random() < 0.1 else turn * rng.choice([1, 1, 1, 3])
            rows.append((conv, number, rng.choice(roles), rng.choice(texts)))
        if rng.random() < 0.2:
            rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("damage", [False, True])
def test_conversations_against_all_edits(spark, damage):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS copies", "'x' AS digest", "2 AS byte", "3 AS kind").repartition(4)
    made = repair.conversations_repaired(repair.damaged(df) if damage else repair.as_they_are(df))
    got = sorted((tuple(r) for r in made.collect()), key=repr)
    assert got == brute(rows, damage)


def test_query_against_all_edits(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert sorted(map(tuple, queries.op12_repair(spark, folder).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("block", [2, 7, 4096])
def test_a_long_conversation_over_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(5)
    rows = [(7, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b.", "c", f"{t}."])) for t in range(150)]
    rows += [(7, 200, "user", "same.")] * 30 + [(8, None, "user", "only.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in repair.conversations_repaired(repair.as_they_are(df)).collect()), key=repr)
    assert got == brute(rows, damage=False)


def test_checkpoints_give_what_all_costs_give():
    rng = random.Random(2)
    for n in [*range(12), 200]:
        turns = bytes(rng.randrange(16) for _ in range(n))
        costs = [repair.AT_END]
        for byte in reversed(turns):
            costs.append(repair.backward(byte, costs[-1]))
        total, letters = repair.repaired(turns)
        assert total == costs[-1][0]
        assert sum(x in "DKR" for x in letters) == n


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.conversations_repaired(repair.damaged(none)).collect() == []
