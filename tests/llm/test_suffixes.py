"""Groups and trees of the substring dedup, tested apart from its documents."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwell.llm import substrings


def brute(texts, least, window):
    """The maximal repeats of each text that a smaller doc_id has, window by window."""
    first = defaultdict(lambda: substrings.LAST)
    split = [t.split() for t in texts]
    for words, doc in zip(split, least):
        for k in range(len(words) - window + 1):
            node = tuple(words[k : k + window])
            first[node] = min(first[node], doc)
    for i, (words, doc) in enumerate(zip(split, least)):
        covered = [False] * (len(words) + 1)
        starts = [k for k in range(len(words) - window + 1) if first[tuple(words[k : k + window])] < doc]
        for k in starts:
            covered[k : k + window] = [True] * window
        for k in range(len(words)):
            if covered[k]:
                yield i, k


@pytest.mark.parametrize("seed", range(30))
def test_repeats_against_every_window(seed):
    luck = random.Random(seed)
    window = luck.choice([1, 2, 3, 7, 12])
    letters = [b"a", b"b", "é".encode(), b"\xff"][: luck.randint(1, 4)]
    texts = list({b" ".join(luck.choices(letters, k=luck.randint(window, 40))) for _ in range(12)})
    least = np.array([luck.randint(-2, 6) for _ in texts])
    sizes, (owner, begin, end) = substrings.repeats(texts, least, window)
    assert sizes.tolist() == [len(t.split()) for t in texts]
    got = {(i, k) for i, a, b in zip(owner.tolist(), begin.tolist(), end.tolist()) for k in range(a, b)}
    assert got == set(brute(texts, least.tolist(), window))
    assert len(set(zip(owner.tolist(), begin.tolist()))) == len(owner)


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5, 8, 50])
def test_suffixes_are_sorted_by_words(depth):
    luck = random.Random(depth)
    numbers = np.array(luck.choices(range(3), k=200))
    ranks = substrings.depth_ranks(numbers, depth).tolist()
    suffixes = [tuple(numbers[k : k + depth].tolist()) for k in range(len(numbers) - depth + 1)]
    assert len(ranks) == len(suffixes)
    order = {s: r for r, s in enumerate(sorted(set(suffixes)))}
    assert depth == 1 or ranks == [order[s] for s in suffixes]


@pytest.mark.parametrize("bound", [20, 150, 400])
def test_prefixes_grow_until_groups_fit(spark, bound):
    """A passage that many texts share has groups above the bound; longer prefixes split them."""
    passage = " ".join(f"p{k % 61}x{k // 61}" for k in range(130))
    rows = [(k, f"own{k} words{k} " + passage + f" end{k} of{k}") for k in range(12)]
    rows += [(100 + k, " ".join(f"w{k}y{j}" for j in range(80))) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = substrings.packed(docs)
    own = substrings.anchors(docs, 50, 10)
    found = (
        own.groupBy("anchor").agg((F.sum("n_windows") > bound).alias("frequent"), F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    wanted = own.join(found, "anchor").groupBy("row_key").agg(
        F.collect_list("anchor").alias("repeated"), F.collect_list("frequent").alias("frequent")
    )
    runs = substrings.stable(substrings.suffixes(texts.join(wanted, "row_key"), 50, 10))
    made, often = substrings.groups(runs, 50, 10, bound)
    held = [{r.anchor: r.n for r in part.groupBy("anchor").agg(F.sum("n_windows").alias("n")).collect()} for part in made]
    assert all(n <= bound for part in held for n in part.values())
    assert (len(held) > 2) == (bound < 400) and (often.isEmpty() or len(held) == 4)
    # Each window of the passage is in one group, or in a group that no prefix makes small enough.
    all_places = [
        (r.doc_id, k) for part in [*made, often] for r in part.collect() for k in range(r.start, r.start + r.n_windows)
    ]
    assert len(all_places) == len(set(all_places))
    assert {(d, k) for d in range(12) for k in range(2, 2 + 130 - 49)} <= set(all_places)
    assert all(d < 100 for d, _ in all_places)
