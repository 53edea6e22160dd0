"""Packing: training sequences of bounded length from examples, by vector bin packing.

An example is the ids of an optional prompt and of a text, then the end id. It is an item of three
sizes: tokens, segments (one) and loss-bearing tokens (all but the prompt's). A sequence is a bin
with a limit on each of the three.

Each task packs the rows it reads; nothing is shuffled. It keeps a window of some hundred items.
A bin takes, again and again, the item that fits and has the greatest dot product of its sizes with
the room left, each relative to its limit. When none fits, the piece of the longest item that fills
the room is cut off. What can't be filled (segments used up, or a task's last items) is closed at the
greatest power of two within it, where no padding is added, and the rest waits for the next bin. So
only powers of two fall short of the limit on tokens. Examples longer than that are cut into
whole sequences first.

Ids are the tokenizer's for the whole text. Its words end at white space, so a worker remembers the
ids of the words between ASCII spaces, in lower case, and asks the tokenizer only for new ones.

Sequences are numbered by task and place, which a task that runs again repeats.

Cases: a null or empty text has the end id only; a null prompt has no ids. Null and equal doc_ids
and repeated rows are examples of their own. Long texts are cut, never shortened. Other columns are not
read. An empty table gives none.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

END = 1
#: Items that wait for a bin at most; half of them, when bins are made.
WINDOW = 1024
#: A letter and the marks that end a word: the tokenizer never joins the two.
MARKS = r"([a-z])([.,;:!?]+\s)"
#: Bytes of text whose words are looked up together (or a longer text).
AT_ONCE = 4 << 20
#: Words whose ids a worker remembers: the first ones, which are the frequent ones, and the latest.
REMEMBERED = 800_000
LATEST = 200_000
#: Pieces in a batch of the result.
PIECES = 8192


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold at most."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


class Words:
    """Ids of texts as little-endian 32-bit integers, remembered by word."""

    def __init__(self, tokenizer):
        self.encode = tokenizer.encode_batch_fast
        self.known: dict[str, bytes] = {}
        self.latest: dict[str, bytes] = {}

    def __call__(self, texts: pa.Array) -> list[bytes]:
        split = words_in(texts)
        words = split.flatten().dictionary_encode()
        known, latest = self.known, self.latest
        own = words.dictionary.to_pylist()
        made = [known.get(w) or latest.get(w) for w in own]
        new = [k for k, ids in enumerate(made) if ids is None]
        asked = self.encode([own[k] for k in new], add_special_tokens=False)
        for k, one in zip(new, asked, strict=True):
            made[k] = np.array(one.ids, "<u4").tobytes()
            (known if len(known) < REMEMBERED else latest)[own[k]] = made[k]
        if len(latest) > LATEST:
            self.latest = {}
        # The ids of all words in a row: each word's, fetched from the row of the different words'.
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        which = words.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[which]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        from_ = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
        ids = np.frombuffer(b"".join(made), "<u4")[np.repeat(from_, lengths) + np.arange(ends[-1])]
        cuts = ends[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


def words_in(texts: pa.Array) -> pa.ListArray:
    """What stands between ASCII spaces, in lower case as the tokenizer takes it, the marks behind a
    letter apart; texts that may hold the name of a special token stay as they are."""
    texts = pc.fill_null(texts, "")
    lowered = pc.replace_substring_regex(pc.ascii_lower(texts), MARKS, r"\1 \2")
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, lowered))


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch by `AT_ONCE` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
    number = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64) // AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(start, stop - start)


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    """One memory for all tasks of a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Words(Tokenizer.from_file(path))


def power_of_two(n: int) -> int:
    """The greatest power of two up to ``n``."""
    return 1 << (n.bit_length() - 1)


@dataclass
class Item:
    """What is left of an example from ``start`` on: ids behind ``start``, of which the first
    ``quiet`` bear no loss."""

    owner: object
    ids: bytes
    total: int
    quiet: int
    start: int = 0

    @property
    def tokens(self) -> int:
        return len(self.ids) // 4

    @property
    def loss(self) -> int:
        return max(0, self.tokens - self.quiet)

    def cut(self, n: int) -> tuple[Item, Item]:
        """The first ``n`` ids and the rest."""
        quiet = min(n, self.quiet)
        return (
            Item(self.owner, self.ids[: 4 * n], self.total, quiet, self.start),
            Item(self.owner, self.ids[4 * n :], self.total, self.quiet - quiet, self.start + n),
        )


class Packer:
    """Takes examples and gives sequences, each a list of items."""

    def __init__(self, limits: Limits = Limits(), window: int = WINDOW):
        self.limits = limits
        self.limit = np.array([limits.tokens, limits.segments, limits.loss], float)
        # The items that wait, each in a place of its own; empty places have no size that fits.
        self.items: list[Item | None] = [None] * window
        self.sizes = np.full((window, 3), np.inf)
        self.empty = list(range(window))[::-1]

    def add(self, item: Item) -> Iterator[list[Item]]:
        whole = self.limits.tokens
        while self.most(item, whole, self.limits.loss) == whole:
            piece, item = item.cut(whole)
            yield [piece]
        if item.tokens:
            if not self.empty:
                yield from self.bins(len(self.items) // 2)
            self.wait(item)

    def wait(self, item: Item) -> None:
        place = self.empty.pop()
        self.items[place] = item
        self.sizes[place] = item.tokens, 1, item.loss

    def take(self, place: int) -> Item:
        item, self.items[place] = self.items[place], None
        self.sizes[place] = np.inf
        self.empty.append(place)
        return item

    @staticmethod
    def most(item: Item, tokens: int, loss: int) -> int:
        """Ids of the item that fit."""
        return min(item.tokens, tokens, item.quiet + loss)

    def bins(self, left: int = 0) -> Iterator[list[Item]]:
        """Sequences, until at most ``left`` items wait."""
        while len(self.items) - len(self.empty) > left:
            yield self.bin()

    def bin(self) -> list[Item]:
        room, chosen = self.limit.copy(), []
        while True:
            fits = np.flatnonzero((self.sizes <= room).all(axis=1))
            if not len(fits):
                break
            best = int(fits[(self.sizes[fits] @ (room / self.limit**2)).argmax()])
            room -= self.sizes[best]
            chosen.append(self.take(best))
        tokens, segments, loss = (int(r) for r in room)
        there = np.isfinite(self.sizes[:, 0])
        if tokens and segments and there.any():
            longest = int(np.where(there, self.sizes[:, 0], 0).argmax())
            n = self.most(self.items[longest], tokens, loss)
            if n:
                piece, rest = self.take(longest).cut(n)
                chosen.append(piece)
                self.wait(rest)
                tokens -= n
        return self.closed(chosen, self.limits.tokens - tokens)

    def closed(self, chosen: list[Item], length: int) -> list[Item]:
        """The sequence, short of a full one only at a power of two; what goes over it waits."""
        over = 0 if length == self.limits.tokens else length - power_of_two(length)
        while over:
            last = chosen.pop()
            if last.tokens > over:
                kept, last = last.cut(last.tokens - over)
                chosen.append(kept)
            over -= last.tokens
            self.wait(last)
        return chosen


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(
    docs: DataFrame,
    ids_of: Callable[[], Callable[[pa.Array], list[bytes]]],
    limits: Limits = Limits(),
    prompt: str | None = None,
    end: int = END,
    with_ids: bool = False,
    window: int = WINDOW,
) -> DataFrame:
    """A row for each piece: doc_id, place and length in its example, checksum of its ids, tokens of the
    example, sequence and place in it; loss-bearing tokens and the ids too if ``with_ids``.

    ``docs`` has doc_id, text and the column ``prompt`` if there is one. ``ids_of`` is called in a task."""
    schema = T.StructType.fromDDL(SCHEMA + (", loss long, ids array<int>" if with_ids else ""))
    arrow = to_arrow_schema(schema)
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = ids_of(), Packer(limits, window)
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def examples():
            for batch in batches:
                for part in parts(batch):
                    owners, texts, *prompts = part.columns
                    asked = encode(prompts[0]) if prompts else [b""] * len(texts)
                    for owner, first, rest in zip(owners.to_pylist(), asked, encode(texts), strict=True):
                        ids = first + rest + last
                        yield Item(owner, ids, len(ids) // 4, len(first) // 4)

        def sequences():
            for example in examples():
                yield from packer.add(example)
            yield from packer.bins()

        def made():
            columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

        for sequence in sequences():
            offset = 0
            for i in sequence:
                row = (i.owner, i.start, i.tokens, zlib.crc32(i.ids), i.total, number, offset)
                rows.append((*row, i.loss, np.frombuffer(i.ids, "<i4")) if with_ids else row)
                offset += i.tokens
            number += 1
            if len(rows) >= PIECES:
                yield made()
                rows.clear()
        yield made()

    wanted = ["doc_id", "text", *([prompt] if prompt else [])]
    return docs.select(*[docs[f"`{c}`"] for c in wanted]).mapInArrow(run, schema)
