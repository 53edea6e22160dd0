"""I-Match fingerprints: hashes of a text's terms within a band of document frequency.

The lexicon is every term whose share of documents lies between `RARE` and `COMMON` (a band of inverse
document frequency), counted over all documents. A fingerprint has one slot for the whole lexicon
and `EACH` slots for each rate of `RATES`: randomised subsets of the lexicon that a term enters by
its hash. A slot is the hash of the sorted distinct terms that a text has of its subset, or empty: 64 bits for
the whole lexicon, which tells texts apart, and 24 for each subset, whose equal slots are only counted.
A text without any lexicon term has all its distinct terms in the first slot. Equal texts have equal
fingerprints; the likeness of two is the share of equal slots among those that either one fills,
which follows the terms that they share.

Counting runs in tasks first: one row a term and flush of at most `FLUSH` terms is shuffled. The
lexicon has at most (mean distinct terms of a document) / RARE terms, whatever the number of
documents, as every one of them stands in RARE of all documents; it is sent to the tasks as 64-bit
hashes.

The next document in order of doc_id is found without a sort of everything in one place: documents
go, compressed, to ranges of doc_id, and the first of each range is also sent to the range before.

Cases: a null text is an empty one. Null doc_ids come last; documents with one doc_id are ordered by
the hash of their text. A single document is its own next one. An empty table gives an empty
result; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell.llm.common import per_batch, spread

RARE, COMMON = 1 / 2000, 1 / 20
RATES = (1 / 4, 1 / 16, 1 / 64, 1 / 256)
EACH = 8
FLUSH = 400_000
EMPTY = "------"
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LAST = 2**63 - 1


def terms(text: str) -> set[bytes]:
    return set(WORD.findall(text.encode().lower()))


def hashed(words: set[bytes]) -> np.ndarray:
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, n): the hash of each term and the number of documents that have it."""

    def run(batches):
        counts = Counter()

        def flushed():
            keys = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(list(counts.values()), pa.int64())],
                names=["term", "n"],
            )

        for batch in batches:
            for text in batch.column(0):
                counts.update(terms(text.as_py() or ""))
                if len(counts) >= FLUSH:
                    yield flushed()
                    counts.clear()
        yield flushed()

    made = docs.select("text").mapInArrow(run, "term long, n long")
    return made.groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, rare: float = RARE, common: float = COMMON) -> np.ndarray:
    """The sorted hashes of the terms in the band."""
    total = docs.count()
    band = document_frequencies(docs).where(
        (F.col("n") >= max(1, rare * total)) & (F.col("n") <= max(1, common * total))
    )
    rows = band.select("term").toArrow()
    return np.sort(rows.column("term").to_numpy().view(np.uint64))


def subsets(words: np.ndarray) -> np.ndarray:
    """For each term the slots it is in, as bits; bit 0 is the whole lexicon."""
    bits = np.ones(len(words), np.uint64)
    for k in range(len(RATES) * EACH):
        h = (words ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
        inside = h < np.uint64(int(RATES[k // EACH] * 2**64))
        bits |= inside.astype(np.uint64) << np.uint64(k + 1)
    return bits


class Printer:
    def __init__(self, words: np.ndarray):
        self.words, self.bits = words, subsets(words)

    def print(self, text: str) -> list[str]:
        """The slots of a text."""
        own = hashed(terms(text))
        slots = [EMPTY] * (1 + len(RATES) * EACH)
        known, bits = own[:0], self.bits[:0]
        if len(self.words) and len(own):
            at = np.searchsorted(self.words, own).clip(max=len(self.words) - 1)
            inside = self.words[at] == own
            known, bits = own[inside], self.bits[at[inside]]
        if not len(known):
            slots[0] = self.hash(own, 64)
            return slots
        filled = int(np.bitwise_or.reduce(bits))
        for k in range(len(slots)):
            if filled >> k & 1:
                inside = known[(bits >> np.uint64(k)) & np.uint64(1) == 1]
                slots[k] = self.hash(inside, 24 if k else 64)
        return slots

    @staticmethod
    def hash(values: np.ndarray, bits: int) -> str:
        return f"{xxhash.xxh64_intdigest(values.tobytes()) >> 64 - bits:0{bits // 4}x}"


def likeness(a: list[str], b: list[str]) -> float:
    """The share of equal slots among the filled ones; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    filled = [(x, y) for x, y in zip(a, b, strict=True) if x != EMPTY or y != EMPTY]
    return sum(x == y for x, y in filled) / len(filled)


def fingerprints(docs: DataFrame, words: np.ndarray | None = None) -> DataFrame:
    """doc_id and fingerprint of each row, over the lexicon ``words`` or the corpus's own."""
    words = lexicon(docs) if words is None else words

    def make():
        printer = Printer(words)
        return lambda ids, texts: {
            "doc_id": ids,
            "fingerprint": ["".join(printer.print(t or "")) for t in texts],
        }

    return per_batch(docs.select("doc_id", "text"), "doc_id long, fingerprint string", make)


def in_ranges(docs: DataFrame) -> DataFrame:
    """(part, tail, place, tie, doc_id, packed): the documents by range of doc_id; rows with tail are
    the first of the next range, the last range's of the first."""
    spark = docs.sparkSession
    place = F.coalesce(F.col("doc_id"), F.lit(LAST))
    placed = docs.select(place.alias("place"))
    total = placed.count()
    parts = max(1, min(8 * spread(spark), total // 32))
    bounds = sorted(
        set(map(int, placed.approxQuantile("place", [k / parts for k in range(1, parts)], 0.1 / parts)))
        if parts > 1
        else []
    )

    def make_numbers():
        return lambda places: {"part": [bisect_right(bounds, p) for p in places], "place": places}

    numbered = per_batch(placed, "part long, place long", make_numbers)
    # One row a range.
    firsts = dict(numbered.groupBy("part").agg(F.min("place")).collect())
    order = sorted(firsts)
    before = {firsts[p]: order[k - 1] for k, p in enumerate(order)}

    def make():
        squeeze = zstandard.ZstdCompressor(level=3).compress

        def work(ids, texts):
            out = {k: [] for k in ("part", "tail", "place", "tie", "doc_id", "packed")}
            for i, text in zip(ids, texts, strict=True):
                raw = (text or "").encode()
                at = LAST if i is None else i
                row = (at, xxhash.xxh64_intdigest(raw) - 2**63, i, squeeze(raw))
                homes = [(bisect_right(bounds, at), False)]
                if at in before:
                    homes.append((before[at], True))
                for home in homes:
                    for name, value in zip(out, (*home, *row), strict=True):
                        out[name].append(value)
            return out

        return work

    return per_batch(
        docs.select("doc_id", "text"),
        "part long, tail boolean, place long, tie long, doc_id long, packed binary",
        make,
    )


def compared(docs: DataFrame) -> DataFrame:
    """The fingerprints of each document, of its edited text (the second half replaced by the
    beginning of the next document), and their likeness; and the likeness to the next document."""
    words = lexicon(docs)
    rows = in_ranges(docs)
    rows = rows.repartition(spread(docs.sparkSession), "part").sortWithinPartitions(
        "part", "tail", "place", "tie"
    )
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    arrow = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])

    def run(batches):
        printer = Printer(words)
        open_ = zstandard.ZstdDecompressor().decompress

        def row(this, after):
            doc_id, text, slots = this
            half = len(text) // 2
            edited = text[: len(text) - half] + after[1][:half]
            own = printer.print(edited)
            return (
                doc_id,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                "".join(slots),
                "".join(own),
                likeness(slots, own),
                likeness(slots, after[2]),
            )

        held = None
        for batch in batches:
            made = []
            columns = (batch.column(k).to_pylist() for k in ("tail", "doc_id"))
            for tail, doc_id, packed in zip(*columns, batch.column("packed"), strict=True):
                if tail and held is None:
                    continue  # a tie of the row that came before
                text = open_(packed.as_py()).decode()
                this = doc_id, text, printer.print(text)
                if held is not None:
                    made.append(row(held, this))
                held = None if tail else this
                if len(made) >= 256:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in made], arrow)
                    made = []
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in made], arrow)

    return rows.select("tail", "doc_id", "packed").mapInArrow(run, schema)
