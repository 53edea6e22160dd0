"""SentencePiece encoding and decoding with spans of the original bytes, from a model file.

A model file is read here: its pieces and scores, and its normaliser. Encoding goes in three steps.

1. Normalising. At each place the longest prefix that the compiled character map holds is replaced
   by its value, else one character is kept; extra spaces go if the model says so, spaces become
   the mark U+2581, and the dummy prefix is put in front. Each normalised byte records the place
   in the original where it came from.
2. Merging. The pair of neighbours whose joined piece has the best score (of equals the leftmost)
   is joined until none is left. Characters without a piece become byte pieces. A text is cut
   where no piece of the model could join what is left and right of the cut, so that words are
   merged once and then remembered (a bounded number of them).
3. Projecting. The places of a piece's first byte and of the byte behind it give its span.

The model file is distributed with the job (its pieces travel with the function); it is not copied
into the library. Only models of the kind BPE are taken.

Cases: a null text is an empty one, without pieces. Very long texts are processed whole; what a
text without cuts costs grows as n log n. Repeated rows are repeated in the result, an empty table
gives an empty result, other columns aren't read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from tierwell.llm.common import per_batch

MARK = "▁"
#: Words remembered by a worker: the first ones, among them all frequent ones, and the latest others.
REMEMBERED, LATEST = 120_000, 40_000
NEVER = float("inf")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def fields(data: bytes):
    """(number, value) of the fields of a protocol-buffer message."""

    def number(at):
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = (4, at) if key & 7 == 5 else (8, at) if key & 7 == 1 else number(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes, and the values it points to."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.values = blob[4 + size :]
        self.starts = bytes(b for b in range(256) if self.units and self.step(0, b) is not None)

    def step(self, node: int, byte: int) -> int | None:
        unit = self.units[node]
        child = node ^ ((unit >> 10) << ((unit & 512) >> 6)) ^ byte
        ok = child < len(self.units) and self.units[child] & 0x800000FF == byte
        return child if ok else None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """How many bytes the longest prefix at ``at`` has, and what replaces it."""
        node, found = 0, None
        for k in range(at, len(text)):
            node = self.step(node, text[k])
            if node is None:
                break
            unit = self.units[node]
            if unit & 256:
                leaf = node ^ ((unit >> 10) << ((unit & 512) >> 6))
                found = k + 1 - at, self.units[leaf] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.values[start : self.values.index(b"\0", start)]

    def apply(self, text: bytes) -> tuple[bytes, np.ndarray | None]:
        """The mapped text and, for each of its bytes and its end, the place in ``text`` (None: the
        same place)."""
        if not self.units:
            return text, None
        interesting = re.compile(b"[" + re.escape(self.starts) + b"]")
        out, places, done, at = [], [], 0, 0
        while (hit := interesting.search(text, at)) is not None:
            at = hit.start()
            found = self.longest(text, at)
            if found is None:  # one character is kept
                at += 1
                while at < len(text) and text[at] & 192 == 128:
                    at += 1
                continue
            out += [text[done:at], found[1]]
            places += [np.arange(done, at), np.full(len(found[1]), at)]
            at += found[0]
            done = at
        out.append(text[done:])
        places.append(np.arange(done, len(text) + 1))
        return b"".join(out), np.concatenate(places)


def chained(pairs: set[str]) -> list[set[str]]:
    """The groups of characters that pairs connect, but for the mark; the largest first."""
    group = {}
    for pair in sorted(pairs):
        if MARK in pair:
            for c in pair:
                if c != MARK:
                    group.setdefault(c, {c})
            continue
        a, b = (group.setdefault(c, {c}) for c in pair)
        if a is not b:
            small, large = sorted((a, b), key=len)
            large |= small
            group.update(dict.fromkeys(small, large))
    return sorted({id(g): g for g in group.values()}.values(), key=lambda g: (-len(g), min(g)))


class PieceModel:
    def __init__(self, data: bytes):
        self.pieces, scores, kinds = [], [], []
        trainer, normaliser = {}, {}
        for key, value in fields(data):
            if key == 1:
                own = dict(fields(value))
                self.pieces.append(own[1].decode())
                scores.append(float(np.frombuffer(own.get(2, b"\0" * 4), "<f4")[0]))
                kinds.append(own.get(3, NORMAL))
            elif key == 2:
                trainer = dict(fields(value))
            elif key == 3:
                normaliser = dict(fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("the model is not of the kind BPE")
        if USER in kinds or UNUSED in kinds or trainer.get(24, 0):
            raise ValueError("user-defined or unused pieces and suffix marks are not supported")
        self.map = CharacterMap(normaliser.get(2, b""))
        self.dummy = bool(normaliser.get(3, 1))
        self.squeeze = bool(normaliser.get(4, 1))
        self.escape = bool(normaliser.get(5, 1))
        self.unknown = kinds.index(UNKNOWN)
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.kinds = kinds
        self.rank = {p: (-scores[k], k) for k, p in enumerate(self.pieces) if kinds[k] == NORMAL}
        self.order = {p: r for p, (r, _) in self.rank.items()}
        self.number = {p: k for p, (_, k) in self.rank.items()}
        self.decimals = [str(k) for k in range(len(kinds))]
        self.plain = [
            "" if kind == CONTROL else self.unknown_text if kind == UNKNOWN else p.replace(MARK, " ")
            for p, kind in zip(self.pieces, kinds, strict=True)
        ]
        self.bytes = {int(p[3:5], 16): k for k, p in enumerate(self.pieces) if kinds[k] == BYTE}
        self.byte_of = {k: b for b, k in self.bytes.items()}
        joined = {p[k : k + 2] for p in self.rank for k in range(len(p) - 1)}
        # Cuts: before a mark that follows another character, and between characters that not even
        # a chain of pieces brings together, such as letters and punctuation.
        marks_join = any(b == MARK and a != MARK for a, b in joined)
        classes = "|".join(
            "[" + "".join(map(re.escape, sorted(group))) + "]+" for group in chained(joined)
        )
        known = "".join(re.escape(c) for c in sorted({c for pair in joined for c in pair} - {MARK}))
        pattern = "(?s:.+)"
        if classes and not marks_join:
            pattern = f"{MARK}*(?:{classes})|{MARK}+|[^{known}{MARK}]"
        self.words = re.compile(pattern)
        self.memory: dict[str, tuple] = {}
        self.latest: dict[str, tuple] = {}

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes and the original place of each and of the end."""
        mark = MARK.encode()
        mapped, places = self.map.apply(text)
        if not mapped:
            return b"", np.zeros(1, np.int64)
        places = np.arange(len(mapped) + 1) if places is None else places
        if self.squeeze:
            raw = np.frombuffer(mapped, np.uint8)
            blank = raw == 32
            keep = ~(blank & np.append(True, blank[:-1]))
            kept = np.flatnonzero(keep)
            if len(kept) and blank[kept[-1]]:
                kept = kept[:-1]
            if not len(kept):
                return b"", np.zeros(1, np.int64)
            mapped = raw[kept].tobytes()
            places = np.append(places[kept], places[kept[-1] + 1])
        if self.dummy:
            mapped, places = b" " + mapped, np.append(places[:1], places)
        if self.escape:
            raw = np.frombuffer(mapped, np.uint8)
            places = np.append(np.repeat(places[:-1], np.where(raw == 32, 3, 1)), places[-1])
            mapped = mapped.replace(b" ", mark)
        return mapped, places

    def merged(self, word: str) -> list[str]:
        """The pieces of a word, by merging the best pair first."""
        parts = list(word)
        rank, n = self.rank, len(parts)
        if n == 1 or word in rank and n == 2:
            return [word]
        if n <= 40:  # few neighbours: look at all of them again
            get = self.order.get
            best = [get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            while (least := min(best)) < NEVER:
                k = best.index(least)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                del best[k]
                if not best:
                    break
                if k < len(best):
                    best[k] = get(parts[k] + parts[k + 1], NEVER)
                if k:
                    best[k - 1] = get(parts[k - 1] + parts[k], NEVER)
            return parts
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def offer(a, b):
            joined = parts[a] + parts[b]
            if (r := rank.get(joined)) is not None:
                heapq.heappush(queue, (r[0], a, b, joined))

        for k in range(n - 1):
            offer(k, k + 1)
        while queue:
            _, a, b, joined = heapq.heappop(queue)
            if parts[a] is None or parts[b] is None or parts[a] + parts[b] != joined or after[a] != b:
                continue
            parts[a], parts[b] = joined, None
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        return [p for p in parts if p is not None]

    def of_word(self, word: str) -> tuple[list[int], list[int]]:
        """Ids, and the number of normalised bytes of each."""
        ids, sizes = [], []
        for piece in self.merged(word):
            raw = piece.encode()
            if piece in self.rank:
                ids.append(self.rank[piece][1])
                sizes.append(len(raw))
            elif self.bytes:
                ids += [self.bytes[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [len(raw)]  # a character is a span of its last byte piece
            elif ids and ids[-1] == self.unknown:
                sizes[-1] += len(raw)
            else:
                ids.append(self.unknown)
                sizes.append(len(raw))
        return ids, sizes

    def ids_of(self, word: str) -> list[int]:
        return self.of_word(word)[0]

    def digests(self, normalised: bytes) -> list[tuple[int, str, str, bytes]]:
        """For each word the number of its ids, their decimals joined by commas, their text, and the
        number of normalised bytes of each id (32-bit integers)."""
        memory, latest = self.memory, self.latest
        if len(latest) > LATEST:
            latest.clear()
        out, get = [], memory.get
        for word in self.words.findall(normalised.decode()):
            made = get(word) or latest.get(word)
            if made is None:
                ids, sizes = self.of_word(word)
                made = (
                    len(ids),
                    ",".join([self.decimals[k] for k in ids]),
                    "".join([self.plain[k] for k in ids])
                    if self.byte_of.keys().isdisjoint(ids)
                    else self.decoded(ids, first=False),
                    np.array(sizes, np.int32).tobytes(),
                )
                if len(word) < 64:
                    (memory if len(memory) < REMEMBERED else latest)[word] = made
            out.append(made)
        return out

    def projected(self, parts: list[tuple], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of ``parts``, of digests, begin and end in the original bytes."""
        ends = np.cumsum(np.frombuffer(b"".join([p[3] for p in parts]), np.int32), dtype=np.int64)
        places = places[np.append(0, ends)]
        return places[:-1], places[1:]

    def encode(self, text: str | None) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and the span of original bytes of each."""
        normalised, places = self.normalised((text or "").encode())
        parts = self.digests(normalised)
        ids = [int(k) for p in parts for k in p[1].split(",")]
        begins, ends = self.projected(parts, places)
        return ids, list(zip(begins.tolist(), ends.tolist(), strict=True))

    def decoded(self, ids: list[int], first: bool = True) -> str:
        """The text of ids: marks are spaces, but for the dummy prefix of the first piece; runs of
        byte pieces are UTF-8, each faulty byte the replacement character."""
        out, run = [], bytearray()
        start = first

        def flush():
            if run:
                out.append(utf8(bytes(run)))
                run.clear()

        for k in ids:
            kind = self.kinds[k]
            if kind == BYTE:
                run.append(self.byte_of[k])
                start = False
                continue
            flush()
            if kind == CONTROL:
                continue
            piece = self.unknown_text if kind == UNKNOWN else self.pieces[k]
            if start and piece.startswith(MARK) and (self.dummy or self.squeeze):
                piece = piece[1:]
                start = self.squeeze and not piece
            else:
                start = False
            out.append(piece.replace(MARK, " "))
        flush()
        return "".join(out)


def utf8(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


@lru_cache(maxsize=4)
def opened(data: bytes) -> PieceModel:
    """One model, and one memory of words, for all tasks of a worker."""
    return PieceModel(data)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


KINDS = {
    "ids": "array<int>",
    "begins": "array<int>",
    "ends": "array<int>",
    "decoded": "string",
    "n_tokens": "long",
    "ids_sha256": "string",
    "spans_sha256": "string",
    "decoded_sha256": "string",
}


def encoded(docs: DataFrame, model: bytes, outputs: list[str], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row and the wanted ``outputs``, of KINDS: ids; begins and ends,
    the byte spans in the original text; the text decoded again from the ids; digests (of the spans:
    begin and end of each piece in turn, as little-endian 64-bit integers)."""
    spans = bool({"begins", "ends", "spans_sha256"} & set(outputs))

    def make():
        m = opened(model)

        def work(texts, *others):
            out = {k: list(v) for k, v in zip(keep, others, strict=True)} | {k: [] for k in outputs}
            for text in texts:
                normalised, places = m.normalised((text or "").encode())
                parts = m.digests(normalised)
                joined = ",".join([p[1] for p in parts])
                if "ids" in out:
                    out["ids"].append(np.fromstring(joined, np.int32, sep=",") if joined else [])
                if spans:
                    both = m.projected(parts, places)
                    for name, own in zip(("begins", "ends"), both, strict=True):
                        if name in out:
                            out[name].append(own)
                    if "spans_sha256" in out:
                        raw = np.stack(both, axis=1).astype("<i8").tobytes()
                        out["spans_sha256"].append(hashlib.sha256(raw).hexdigest())
                if "n_tokens" in out:
                    out["n_tokens"].append(sum([p[0] for p in parts]))
                if "ids_sha256" in out:
                    out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                if "decoded" in out or "decoded_sha256" in out:
                    plain = "".join([p[2] for p in parts[1:]])
                    if parts:
                        plain = m.decoded([int(k) for k in parts[0][1].split(",")]) + plain
                    if "decoded" in out:
                        out["decoded"].append(plain)
                    if "decoded_sha256" in out:
                        out["decoded_sha256"].append(hashlib.sha256(plain.encode()).hexdigest())
            return out

        return work

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join(kinds + [f"{k} {KINDS[k]}" for k in outputs])
    return per_batch(docs.select("text", *keep), schema, make)
