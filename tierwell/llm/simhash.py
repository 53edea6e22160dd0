"""SimHash near-duplicates: linked within a bit distance by a vantage-point tree.

Texts become 64-bit fingerprints; equal ones are merged before anything is compared. The distinct
fingerprints are dealt out by a vantage-point tree: a node holds a pivot and a radius, what lies
within goes inside, the rest outside. A fingerprint outside whose distance is within `bits` of the
radius also visits the inside as a guest, which by the triangle inequality is every place where a
partner can be; pairs are looked for between natives, and between natives and guests. Each shard
goes on splitting in memory. A shard returns a spanning star of each of its groups, not its pairs,
so a group of n near copies costs n rows.

The tree's upper part is built on samples of 64 fingerprints a leaf; it only decides where
fingerprints go, and every one of them goes somewhere. It grows `LEVELS` levels at a time: the first
on the driver, from a sample whose size doesn't depend on the table, the subtrees below it in tasks,
one a node, which reach the node's fingerprints through the same shuffle. So no one holds the whole
tree. A shard has about `SHARD` natives, so its memory doesn't grow with the table; the number of
shards does, and with each doubling of it guests grow by about 1.4.

Nulls: a null text is an empty one. Texts without words have the fingerprint zero. A null doc_id is
a document, but no component is named after it unless nothing else is in it (then null). Repeated
rows are repeated in the result. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell.llm.common import per_batch, row_hash, stable

#: Natives of a shard.
SHARD = 16_384
SAMPLED_PER_SHARD = 64
#: Levels of the tree that grow at a time, so a sample has at most SAMPLED_PER_SHARD << LEVELS fingerprints.
LEVELS = 8
#: Tasks that deal out the fingerprints of a node below the first levels.
SALTS = 8
#: Below this many a node is compared in full.
LEAF = 256


def simhash(text: str | None, size: int, seed: int = 42) -> int:
    """A bit is set if it is in more than half of the hashes of the text's word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-size] + 1)).tolist()
    hash_ = xxhash.xxh64_intdigest
    total = len(starts)
    hashes = np.fromiter(
        (hash_(line[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)),
        np.uint64,
        total,
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, total, 8192):
        block = hashes[at : at + 8192]
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fingerprint (a long with the same 64 bits) and the long columns ``keep`` of each row."""

    def make():
        def work(ids, texts, *others):
            made = np.array([simhash(text, shingle) for text in texts], np.uint64)
            return {"doc_id": ids, "fingerprint": made.view(np.int64)} | dict(zip(keep, others, strict=True))

        return work

    schema = "doc_id long, fingerprint long" + "".join(f", {k} long" for k in keep)
    return per_batch(docs.select("doc_id", "text", *keep), schema, make)


def distance(values: np.ndarray, pivot: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ pivot).astype(np.int16)


def pick(values: np.ndarray) -> tuple[np.uint64, int]:
    """The candidate with the widest spread of distances, and their median. The candidates are
    places in ``values``, so the same values give the same tree."""
    best = None
    for at in np.linspace(0, len(values) - 1, 8).astype(int):
        d = distance(values, values[at])
        if best is None or d.var() > best[0]:
            best = (d.var(), values[at], int(np.median(d)))
    return best[1], best[2]


def grow(sample: np.ndarray, depth: int, name: int = 1):
    """Nested tuples (pivot, radius, inside, outside); a leaf is its number."""
    if depth == 0 or len(sample) < 2:
        return name
    pivot, radius = pick(sample)
    near = distance(sample, pivot) <= radius
    if near.all():
        return name
    return (
        pivot,
        radius,
        grow(sample[near], depth - 1, 2 * name),
        grow(sample[~near], depth - 1, 2 * name + 1),
    )


def split(values: np.ndarray, guest: np.ndarray, pivot, radius: int, bits: int):
    """Masks of what goes inside and outside, and the guests among what goes inside."""
    d = distance(values, pivot)
    inside = d <= np.where(guest, radius + bits, radius)
    visits = ~guest & (d > radius) & (d <= radius + bits)
    outside = np.where(guest, d >= radius + 1 - bits, d > radius)
    return inside | visits, outside, guest | visits


def route(tree, values: np.ndarray, bits: int, guest: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, values, which of them are guests) for each leaf that gets any."""
    found, todo = [], [(tree, values, guest)]
    while todo:
        node, v, guest = todo.pop()
        if not len(v):
            continue
        if isinstance(node, int):
            found.append((node, v, guest))
            continue
        pivot, radius, near, far = node
        inside, outside, as_guest = split(v, guest, pivot, radius, bits)
        todo.append((near, v[inside], as_guest[inside]))
        todo.append((far, v[outside], guest[outside]))
    return found


def star(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that each of n nodes is connected to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def shard_links(values: np.ndarray, guest: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smaller node) that connect what a shard's close pairs connect."""
    left, right = [], []
    todo = [(np.arange(len(values)), guest)]
    while todo:
        at, g = todo.pop()
        own = at[~g]
        if not len(own) or len(at) < 2:
            continue
        v = values[at]
        if len(at) > LEAF:
            pivot, radius = pick(values[own])
            inside, outside, as_guest = split(v, g, pivot, radius, bits)
            if not (inside.all() or outside.all()):
                todo.append((at[inside], as_guest[inside]))
                todo.append((at[outside], g[outside]))
                continue
        near, far = [], []
        for start in range(0, len(own), LEAF):
            rows = own[start : start + LEAF]
            i, j = np.nonzero(np.bitwise_count(values[rows][:, None] ^ v[None, :]) <= bits)
            i, j = rows[i], at[j]
            near.append(i[i != j])
            far.append(j[i != j])
        near, far = np.concatenate(near), np.concatenate(far)
        if len(near):  # a star for each leaf, so that what is kept stays in proportion
            nodes, places = np.unique(np.concatenate((near, far)), return_inverse=True)
            root = star(places[: len(near)], places[len(near) :], len(nodes))
            left.append(nodes)
            right.append(nodes[root])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    root = star(a, b, len(values))
    at = np.flatnonzero(root != np.arange(len(values)))
    return at, root[at]


DEALT = "shard long, fingerprint long, guest boolean"


def routed(tree, values: np.ndarray, guest: np.ndarray, bits: int):
    for leaf, v, as_guest in route(tree, values.view(np.uint64), bits, guest):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(v), leaf)), pa.array(v.view(np.int64)), pa.array(as_guest)],
            names=["shard", "fingerprint", "guest"],
        )


def dealt_further(dealt: DataFrame, share: float, depth: int, bits: int) -> DataFrame:
    """The fingerprints of each node dealt to the leaves of a subtree of its own, of ``depth``
    levels, built on a ``share`` of its natives."""
    most = SAMPLED_PER_SHARD << depth

    def grown(table):
        values = table.column("fingerprint").to_numpy().view(np.uint64)
        mixed = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        values = np.sort(values[np.lexsort((values, mixed))][:most])
        node = table.column("shard")[0].as_py()
        return pa.table({"shard": [node], "tree": [pickle.dumps(grow(values, depth, node))]})

    def deal(batches):
        node, tree = None, None
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for first, last in zip(cuts, cuts[1:]):
                part = batch.slice(first, last - first)
                if first == last:
                    continue
                if shard[first] != node:
                    node, tree = shard[first], int(shard[first])
                seeds = [t for t in part.column(3).to_pylist() if t is not None]
                if seeds:  # a node's subtree stands before its fingerprints
                    tree = pickle.loads(seeds[0])
                rows = part.filter(part.column(3).is_null())
                guest = rows.column(2).to_numpy(zero_copy_only=False)
                yield from routed(tree, rows.column(1).to_numpy(), guest, bits)

    sampled = dealt.where(~F.col("guest") & (F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 30)) < int(share * (1 << 30))))
    trees = stable(sampled.select("shard", "fingerprint").groupBy("shard").applyInArrow(grown, "shard long, tree binary"))
    salt = F.pmod(F.xxhash64(F.lit(1), "fingerprint"), F.lit(SALTS)).cast("int")
    rows = dealt.select("*", F.lit(None).cast("binary").alias("tree"), salt.alias("salt"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    seeds = trees.select("shard", F.lit(0).cast("long").alias("fingerprint"), F.lit(False).alias("guest"), "tree", salts)
    together = rows.union(seeds).repartition("shard", "salt")
    together = together.sortWithinPartitions("shard", F.col("tree").isNull())
    return together.select("shard", "fingerprint", "guest", "tree").mapInArrow(deal, DEALT)


def links(distinct: DataFrame, bits: int = 2, shard: int = SHARD, levels: int = LEVELS) -> DataFrame:
    """Star edges (a, b) between the values of the column ``fingerprint``, which are distinct."""
    total = distinct.count()
    depth = max(0, int(np.ceil(np.log2(max(1, total) / shard))))
    upper = min(depth, levels)
    sampled = (
        distinct.orderBy(F.xxhash64("fingerprint"), "fingerprint")
        .limit(SAMPLED_PER_SHARD << upper)
        .toPandas()["fingerprint"]
        if depth
        else []
    )
    tree = grow(np.sort(np.array(sampled, np.int64).view(np.uint64)), upper)

    def deal(batches):
        for batch in batches:
            values = batch.column(0).to_numpy()
            yield from routed(tree, values, np.zeros(len(values), bool), bits)

    def in_shard(table):
        order = np.argsort(table.column("fingerprint").to_numpy(), kind="stable")
        values = table.column("fingerprint").to_numpy()[order]
        guest = table.column("guest").to_numpy()[order]
        a, b = shard_links(values.view(np.uint64), guest, bits)
        return pa.table({"a": values[a], "b": values[b]})

    dealt = distinct.select("fingerprint").mapInArrow(deal, DEALT)
    for done in range(levels, depth, levels):
        more = min(levels, depth - done)
        share = min(1.0, (SAMPLED_PER_SHARD << (done + more)) / total)
        dealt = dealt_further(stable(dealt), share, more, bits)
    return dealt.groupBy("shard").applyInArrow(in_shard, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) is connected to.

    Large star and small star in turn until nothing changes. Each round is written to the shared
    folder; the driver sees one row a round.
    """

    def neighbours(e):
        return e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def with_least(e):
        least = e.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("least"))
        return e.join(least, e.a == least.k).withColumn("least", F.least("a", "least"))

    def sign(e):
        return e.agg(
            F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))
        ).first()

    edges = stable(edges.select("a", "b").where("a <> b").distinct())
    before = sign(edges)
    while before[0]:
        large = with_least(neighbours(edges)).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = with_least(down)
        edges = stable(
            small.select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(small.select("a", F.col("least").alias("b")))
            .where("a <> b")
            .distinct()
        )
        now = sign(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def components(docs: DataFrame, shingle: int = 3, bits: int = 2, shard: int = SHARD) -> DataFrame:
    """doc_id, fingerprint (long) and component_id (smallest doc_id reachable) of each row."""
    printed = stable(fingerprints(docs, shingle))
    named = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    named = stable(named)
    rooted = connected(links(named, bits, shard))
    grouped = named.join(rooted, named.fingerprint == rooted.node, "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = grouped.join(least, "root").select(
        F.col("fingerprint").alias("key"), "component_id"
    )
    return printed.join(classes, printed.fingerprint == classes.key, "left").select(
        "doc_id", "fingerprint", "component_id"
    )


def without_near_copies(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """The smallest row of each group of near copies: by doc_id, nulls last, then by a hash of the row.

    So of rows under one doc_id each is judged by its own text, and of exact repeats one stays."""
    own = next(f"row_hash{k}" for k in range(len(docs.columns) + 1) if f"row_hash{k}" not in docs.columns)
    hashed = docs.withColumn(own, row_hash(docs))
    printed = stable(fingerprints(hashed, shingle, (own,)))
    counted = printed.groupBy("fingerprint", "doc_id", own).agg(F.count(F.lit(1)).alias("times"))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", own, "times")
    named = stable(counted.groupBy("fingerprint").agg(F.min(row).alias("first")))
    rooted = connected(links(named, bits, SHARD))
    grouped = named.join(rooted, named.fingerprint == rooted.node, "left")
    least = grouped.groupBy(F.coalesce("root", "fingerprint")).agg(F.min("first").alias("first"))
    first = F.col("first")
    kept = stable(least.select(first["doc_id"].alias("i"), first[own].alias("h"), first["times"].alias("times")))

    def rows(which: DataFrame) -> DataFrame:
        same = F.col(f"d.{own}") == F.col("k.h")
        same &= F.col("d.doc_id").eqNullSafe(F.col("k.i"))
        return hashed.alias("d").join(which.alias("k"), same, "left_semi")

    # Only rows that are repeated exactly need to be moved to find one of each.
    once, again = rows(kept.where("times = 1")), rows(kept.where("times > 1"))
    return once.union(again.dropDuplicates(["doc_id", own])).drop(own)
