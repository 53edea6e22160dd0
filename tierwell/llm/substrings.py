"""Substring dedup: word windows that already start in an earlier document, by prefix-partitioned suffix trees.

A window is `window` consecutive words: a suffix of a text, cut off at that depth. Suffixes are
split into groups by a prefix of words, and the tree of a group is built where the group is.

1. The prefix of a window is the least of its `prefix`-word hashes (by hash, then place), its
   anchor. Equal windows have equal anchors at equal places, so a text's suffixes that share one
   travel together, as one segment of words. Summing up finds the anchors of two or more texts; a
   window whose anchor stands in one text only can't be repeated and goes no further.
2. A group of more than `GROUP` windows would not fit a task: its prefix is lengthened by `LONGER`
   words, which splits the group, until each fits. Segments hold all words that this needs.
   Windows that are in a larger group even with the longest prefix below `window` words are
   leaves of very few, very large nodes: a node needs only its smallest doc_id, which is
   aggregated before the shuffle and joined back, so no task holds them. There, and only there, a
   node is known by the SHA-256 of its words.
3. Groups are cut out of a sorted partition, a bounded number of bytes at a time. Equal segments
   become one, its words are numbered, and its suffixes are sorted by these numbers, doubling the
   depth from one word to `window`. Suffixes of equal rank are the leaves below one internal node
   of that depth. Words decide; hashes only group.
4. A leaf whose node has a smaller doc_id gives a range of words. Ranges of neighbouring leaves
   join to maximal repeats. They meet their text again by row key, and the words in them go.

Texts move between stages compressed.

Cases: a null or blank text has no words. A null doc_id counts as larger than all. Rows with equal
doc_id don't remove each other's words. Repeated rows are repeated in the result, ties and extra
columns don't matter, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwell.llm.common import per_batch, quoted, stable

WINDOW = 50
PREFIX = 10
#: Words by which the prefix of a group of more than GROUP windows is lengthened.
LONGER = 10
GROUP = 131_072
#: Windows of a row; a longer run of windows with one anchor takes several.
RUN = 4096
#: Bytes of words whose suffixes a task sorts at a time.
AT_ONCE = 8_000_000

LAST = 2**63 - 1
BASE = np.uint64(0x9E3779B97F4A7C15)
FIXED_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * FIXED_MIX
    return h ^ (h >> np.uint64(32))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, by doubling."""
    made, length, rest = None, 0, size
    step, span = hashes, 1
    power = BASE
    while True:
        if rest & 1:
            if made is None:
                made, length = step, span
            else:  # made covers `length` words, then comes step
                n = len(hashes) - length - span + 1
                made = made[:n] * power + step[length : length + n]
                length += span
        rest >>= 1
        if not rest:
            return mixed(made)
        step = step[:-span] * power + step[span:]
        span *= 2
        power = np.uint64(int(power) ** 2 % 2**64)


def least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each run of ``span`` values."""
    width = 1
    while width * 2 <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def anchors_of(hashes: np.ndarray, window: int, prefix: int) -> np.ndarray:
    """The anchor of each window."""
    return least(grams(hashes, prefix), window - prefix + 1)


def row_key(doc_id: int | None, text: bytes) -> int:
    """Rows of one doc_id and text have one key."""
    seed = (LAST if doc_id is None else doc_id) & (2**64 - 1)
    return xxhash.xxh64_intdigest(text, seed) - 2**63


def packed(docs: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """doc_id, row key and compressed text, and the columns ``carried`` as a struct ``rest``."""
    rest = [c for c in carried or () if c not in ("doc_id", "text")]
    docs = docs.select("doc_id", "text", *([F.struct(*map(quoted, rest)).alias("rest")] if rest else []))
    schema = T.StructType.fromDDL("doc_id long, row_key long, packed binary, no_text boolean")
    schema = T.StructType([*schema, *[f for f in docs.schema if f.name == "rest"]])

    def make():
        squeeze = zstandard.ZstdCompressor(level=3).compress

        def work(ids, texts, others=None):
            raw = [(t or "").encode() for t in texts]
            return {
                "doc_id": ids,
                "row_key": [row_key(i, t) for i, t in zip(ids, raw, strict=True)],
                "packed": [squeeze(t) for t in raw],
                "no_text": [t is None for t in texts],
                "rest": others,
            }

        return work

    return per_batch(docs, schema, make)


def anchors(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    """(row_key, anchor, n_windows): the distinct anchors of each text and their windows."""

    def make():
        def work(ids, texts):
            keys, found, sizes = [], [], []
            for i, text in zip(ids, texts, strict=True):
                raw = (text or "").encode()
                words = raw.split()
                if len(words) >= window:
                    own = anchors_of(word_hashes(words), window, prefix)
                    starts = np.flatnonzero(np.diff(own, prepend=own[0] + np.uint64(1)))
                    kinds, at = np.unique(own[starts], return_inverse=True)
                    found.append(kinds.view(np.int64))
                    keys.append(np.full(len(kinds), row_key(i, raw)))
                    lengths = np.diff(np.append(starts, len(own)))
                    sizes.append(np.bincount(at, lengths).astype(np.int64))
            empty = np.empty(0, np.int64)
            return {
                "row_key": np.concatenate(keys) if keys else empty,
                "anchor": np.concatenate(found) if found else empty,
                "n_windows": np.concatenate(sizes) if sizes else empty,
            }

        return work

    return per_batch(docs.select("doc_id", "text"), "row_key long, anchor long, n_windows long", make)


RUNS = "anchor long, n_windows long, doc_id long, row_key long, start long, segment binary"


def segments(words: list[bytes], anchor: np.ndarray, chosen: np.ndarray, window: int) -> Iterator[tuple]:
    """(anchor, number of windows, first window, words) of each run of chosen windows with one
    anchor, or of `RUN` of them."""
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (chosen[1:] != chosen[:-1])) + 1
    cuts = [0, *cuts.tolist(), len(anchor)]
    for first, last in zip(cuts, cuts[1:]):
        if chosen[first]:
            for start in range(first, last, RUN):
                n = min(RUN, last - start)
                begin = int(stops[start - 1]) + 1 if start else 0
                yield int(anchor[start]), n, start, joined[begin : int(stops[start + n + window - 2])]


def suffixes(candidates: DataFrame, window: int, prefix: int) -> DataFrame:
    """The suffixes whose anchors are repeated (`RUNS`, and whether the anchor is frequent).

    ``candidates`` has doc_id, packed text, its anchors and which of them are frequent."""

    def make():
        open_ = zstandard.ZstdDecompressor().decompress

        def work(ids, texts, keys, repeated, frequent):
            out = {k: [] for k in ("anchor", "n_windows", "doc_id", "row_key", "start", "segment", "frequent")}
            for i, text, key, some, often in zip(ids, texts, keys, repeated, frequent, strict=True):
                words = open_(text).split()
                own = anchors_of(word_hashes(words), window, prefix).view(np.int64)
                many = {a for a, f in zip(some, often, strict=True) if f}
                for anchor, n, start, segment in segments(words, own, np.isin(own, some), window):
                    out["anchor"].append(anchor)
                    out["n_windows"].append(n)
                    out["doc_id"].append(LAST if i is None else i)
                    out["row_key"].append(key)
                    out["start"].append(start)
                    out["segment"].append(segment)
                    out["frequent"].append(anchor in many)
            return out

        return work

    return per_batch(
        candidates.select("doc_id", "packed", "row_key", "repeated", "frequent"),
        RUNS + ", frequent boolean",
        make,
    )


def lengthened(runs: DataFrame, window: int, prefix: int) -> DataFrame:
    """The suffixes of ``runs`` by prefixes of ``prefix`` words (`RUNS`)."""

    def make():
        def work(ids, keys, starts, texts):
            out = {k: [] for k in ("anchor", "n_windows", "doc_id", "row_key", "start", "segment")}
            for i, key, at, text in zip(ids, keys, starts, texts, strict=True):
                words = text.split()
                own = anchors_of(word_hashes(words), window, prefix).view(np.int64)
                for anchor, n, start, segment in segments(words, own, np.ones(len(own), bool), window):
                    out["anchor"].append(anchor)
                    out["n_windows"].append(n)
                    out["doc_id"].append(i)
                    out["row_key"].append(key)
                    out["start"].append(at + start)
                    out["segment"].append(segment)
            return out

        return work

    return per_batch(runs.select("doc_id", "row_key", "start", "segment"), RUNS, make)


def ranges_of(keys: np.ndarray, places: np.ndarray, window: int):
    """Word ranges [from, to) that the windows at ``places`` of the rows ``keys`` cover."""
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (places[1:] > places[:-1] + window)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(keys)) - 1 if len(starts) else starts
    return keys[starts], places[starts], places[ends] + window


def depth_ranks(numbers: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each suffix by its first ``depth`` words, for those that have as many."""

    def paired(rank: np.ndarray, step: int) -> np.ndarray:
        if not step:
            return rank
        pairs = rank[:-step] * (int(rank.max(initial=0)) + 1) + rank[step:]
        return np.unique(pairs, return_inverse=True)[1]

    span, rank = 1, numbers
    while span * 2 <= depth:
        rank, span = paired(rank, span), span * 2
    return paired(rank, depth - span)


def repeats(texts: list[bytes], least: np.ndarray, window: int):
    """The words of each text, and (text, start, stop) of the repeats that a smaller doc_id has;
    ``least`` is the smallest doc_id of each text. All texts have ``window`` words or more."""
    number = defaultdict()
    number.default_factory = number.__len__
    words = [np.array([number[w] for w in t.split()], np.int64) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.cumsum(sizes) - sizes
    windows = sizes - window + 1
    owner = np.repeat(np.arange(len(texts)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    # Numbers across the end of a text are ranked too, but no window starts there.
    node = depth_ranks(np.concatenate(words), window)[begins[owner] + place]
    first = np.full(int(node.max()) + 1, LAST)
    np.minimum.at(first, node, least[owner])
    again = first[node] < least[owner]
    return sizes, ranges_of(owner[again], place[again], window)


def repeated_in_groups(runs: DataFrame, window: int, at_once: int = AT_ONCE) -> DataFrame:
    """(row_key, start, stop) of the windows that start in a smaller doc_id too. Whole groups of
    an anchor are taken until they hold ``at_once`` bytes."""

    def solve(batches) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        doc, key, start = (table.column(c).to_numpy() for c in ("doc_id", "row_key", "start"))
        coded = table.column("segment").combine_chunks().dictionary_encode()
        kind = coded.indices.to_numpy()
        least = np.full(len(coded.dictionary), LAST)
        np.minimum.at(least, kind, doc)
        sizes, (owner, begin, end) = repeats(coded.dictionary.to_pylist(), least, window)
        whole = doc > least[kind]
        rest = np.flatnonzero(~whole)
        owned = np.bincount(owner, minlength=len(least))
        each = owned[kind[rest]]
        row = np.repeat(rest, each)
        part = np.arange(len(row)) + np.repeat((np.cumsum(owned) - owned)[kind[rest]] - (np.cumsum(each) - each), each)
        made = (
            np.concatenate([key[whole], key[row]]),
            np.concatenate([start[whole], start[row] + begin[part]]),
            np.concatenate([start[whole] + sizes[kind[whole]], start[row] + end[part]]),
        )
        return pa.RecordBatch.from_arrays([pa.array(m, pa.int64()) for m in made], names=["row_key", "start", "stop"])

    def run(batches):
        waiting, held, last = [], 0, None
        for batch in batches:
            anchor = batch.column("anchor").to_numpy()
            size = np.cumsum(pc.binary_length(batch.column("segment")).to_numpy())
            cuts = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor)) if len(anchor) else ()
            begin = done = 0
            for cut in cuts:  # a group ends before `cut`, unless the next batch goes on with it
                if held >= at_once and anchor[done] != last:
                    if done > begin:
                        waiting.append(batch.slice(begin, done - begin))
                    yield solve(waiting)
                    waiting, held, begin = [], 0, done
                held += int(size[cut - 1]) - (int(size[done - 1]) if done else 0)
                last, done = anchor[done], cut
            if done > begin:
                waiting.append(batch.slice(begin, done - begin))
        if waiting:
            yield solve(waiting)

    grouped = runs.repartition("anchor").sortWithinPartitions("anchor")
    return grouped.select("anchor", "doc_id", "row_key", "start", "segment").mapInArrow(
        run, "row_key long, start long, stop long"
    )


def repeated_windows(runs: DataFrame, window: int) -> DataFrame:
    """The same for windows of the largest groups: the smallest doc_id of each node is aggregated and joined."""

    def make():
        def work(ids, keys, starts, texts):
            out = {"node": [], "doc_id": [], "row_key": [], "start": [], "stop": []}
            for i, key, at, text in zip(ids, keys, starts, texts, strict=True):
                words = text.split()
                for k in range(len(words) - window + 1):
                    out["node"].append(hashlib.sha256(b" ".join(words[k : k + window])).digest())
                    out["doc_id"].append(i)
                    out["row_key"].append(key)
                    out["start"].append(at + k)
                    out["stop"].append(at + k + window)
            return out

        return work

    each = per_batch(
        runs.select("doc_id", "row_key", "start", "segment"),
        "node binary, doc_id long, row_key long, start long, stop long",
        make,
    )
    first = each.groupBy(F.col("node").alias("same")).agg(F.min("doc_id").alias("first_id"))
    again = each.join(first, each.node == first.same).where("doc_id > first_id")
    return again.select("row_key", "start", "stop")


def groups(runs: DataFrame, window: int, prefix: int, group: int) -> tuple[list[DataFrame], DataFrame]:
    """The suffixes in groups of up to ``group`` windows, by length of their prefixes, and those
    that no prefix shorter than the window brings into one."""
    made, often = [runs.where("not frequent")], runs.where("frequent")
    while prefix + LONGER < window and not often.isEmpty():
        prefix += LONGER
        split = stable(lengthened(often, window, prefix))
        sizes = split.groupBy(F.col("anchor").alias("same")).agg(
            (F.sum("n_windows") > group).alias("frequent"), (F.min("doc_id") < F.max("doc_id")).alias("shared")
        )
        split = split.join(sizes.where("shared"), split.anchor == sizes.same).drop("same", "shared")
        made.append(split.where("not frequent"))
        often = split.where("frequent")
    return made, often


def repeated_ranges(
    docs: DataFrame, texts: DataFrame, window: int, prefix: int, group: int
) -> DataFrame:
    """row_key and the word ranges to remove, [(start, stop), ...] in any order."""
    own = stable(anchors(docs, window, prefix))
    counted = own.groupBy(F.col("anchor").alias("same")).agg(
        F.count(F.lit(1)).alias("n"), (F.sum("n_windows") > group).alias("frequent")
    )
    counted = counted.where("n > 1").drop("n")
    wanted = (
        own.join(counted, own.anchor == counted.same)
        .groupBy(F.col("row_key").alias("wanted"))
        .agg(F.collect_set(F.struct("anchor", "frequent")).alias("found"))
    )
    candidates = texts.join(wanted, texts.row_key == wanted.wanted).select(
        "doc_id",
        "packed",
        "row_key",
        F.col("found.anchor").alias("repeated"),
        F.col("found.frequent").alias("frequent"),
    )
    made, often = groups(stable(suffixes(candidates, window, prefix)), window, prefix, group)
    found = repeated_windows(often, window)
    for runs in made:
        found = found.union(repeated_in_groups(runs, window))
    return found.groupBy(F.col("row_key").alias("cut")).agg(
        F.collect_set(F.struct("start", "stop")).alias("ranges")
    )


def kept_mask(n: int, ranges) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    for r in ranges or ():
        edge[r["start"]] += 1
        edge[r["stop"]] -= 1
    return np.cumsum(edge[:-1]) == 0


def with_ranges(docs: DataFrame, carried=None, window=WINDOW, prefix=PREFIX, group=GROUP):
    """The packed rows of ``docs`` and the word ranges each loses (null: none)."""
    cut = repeated_ranges(docs, packed(docs), window, prefix, group)
    texts = packed(docs, carried)
    return texts.join(cut, texts.row_key == cut.cut, "left").drop("cut", "row_key")


def kept_digests(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words joined by spaces."""

    def make():
        open_ = zstandard.ZstdDecompressor().decompress

        def work(ids, texts, ranges):
            out = {"doc_id": ids, "n_words": [], "n_removed": [], "kept_sha256": []}
            for text, r in zip(texts, ranges, strict=True):
                words = open_(text).split()
                n = len(words)
                if r:
                    words = [words[k] for k in np.flatnonzero(kept_mask(n, r)).tolist()]
                out["n_words"].append(n)
                out["n_removed"].append(n - len(words))
                out["kept_sha256"].append(hashlib.sha256(b" ".join(words)).hexdigest())
            return out

        return work

    rows = with_ranges(docs, **settings).select("doc_id", "packed", "ranges")
    return per_batch(
        rows, "doc_id long, n_words long, n_removed long, kept_sha256 string", make
    )


WORD_AND_SPACE = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def kept_texts(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` without the repeated words, and n_chars counted again if there is one.

    A text that loses no word stays as it is; else each kept word brings the space behind it."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]

    def make():
        open_ = zstandard.ZstdDecompressor().decompress

        def work(ids, texts, missing, ranges, others=None):
            kept = []
            for text, none, r in zip(texts, missing, ranges, strict=True):
                raw = open_(text)
                if r:
                    words = WORD_AND_SPACE.findall(raw)
                    keep = np.flatnonzero(kept_mask(len(words), r)).tolist()
                    raw = b"".join([words[k] for k in keep]).rstrip()
                kept.append(None if none else raw.decode())
            return {"doc_id": ids, "text": kept, "rest": others}

        return work

    rows = with_ranges(docs, rest, **settings)
    columns = ["doc_id", "packed", "no_text", "ranges", *(["rest"] if rest else [])]
    schema = T.StructType.fromDDL("doc_id long, text string")
    schema = T.StructType([*schema, *[f for f in rows.schema if f.name == "rest"]])
    made = per_batch(rows.select(*columns), schema, make)
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return made.select(*[(own.get(c) if c in own else F.col("rest")[c]).alias(c) for c in docs.columns])
