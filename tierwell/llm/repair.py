"""Repair of conversation structure: the cheapest edits that make the roles of a conversation
`(s?(ua)+)?` (an optional system turn, then user and assistant by turns), by dynamic programming.

Edits: Keep costs 0, Rerole to user or assistant 2, Delete 3, Insert of an empty user or assistant
turn 2; a truncated turn that isn't deleted adds 1; blank and duplicate turns must be deleted. Four states tell
what the kept roles so far end in (nothing, s, u, a); from each, one role follows a Rerole or Insert.

1. Each turn becomes one byte: first letter of its role, and its first fault (blank, duplicate of an earlier turn
   of the conversation, truncated). Duplicates are found by counts per conversation and digest, joined
   back, so a text that fills a conversation is aggregated before the shuffle. Turns are sorted by
   range of conversation, turn, role and digest, so a long conversation spreads over tasks; each task gives the
   bytes of a conversation in blocks, with what counting across blocks needs.
2. A conversation's bytes meet in one row, a byte a turn, as its audit has in the result. Backward,
   the cost of ending well from each state is kept only at every checkpoint, the root of the number of
   turns apart. Walking forward, each block's costs are computed again and the tight edit whose
   letter is least in ASCII is taken, D before I before K before R. State and letter fix the next state, so
   the audit is the least of all cheapest ones.
3. Texts are sorted by conversation and turn behind their audit, and read once as a stream: the
   audit's letters say what becomes of each turn, and the repaired turns go into the digest.

Turns with the same turn number stand in order of role, then of a digest of role and text; null turns
come first. A conversation's texts are read by one task, a batch at a time, because its digest is one.

Cases: a null role or text is one space. A null conv_id is a conversation of its own, as is any other value.
Repeated rows are duplicates. Very long texts are read whole. Other columns are not read. A
conversation without turns left, or without any, has counts of zero and no edits; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tierwell.llm.common import per_batch, stable

SPACES = " \t\n\x0b\f\r"
#: Turns of a conversation in one row before its bytes meet.
BLOCK = 4096

# Costs of the edits, and what a truncated turn adds.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# States: nothing yet, s, u, a. The state after a role's letter, and the state and role that an
# Insert or Rerole leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}

# A turn's byte: letter of its role (0 for any other), then fault.
LETTERS = ("", "s", "u", "a")
WHOLE, CUT, BLANK, DUPLICATE = range(4)
#: Costs of ending well when no turn is left: two Inserts after s, one after u.
AT_END = (0, 2 * INSERT, INSERT, 0)


def _edits(byte: int) -> tuple[tuple[tuple[int, int] | None, ...], ...]:
    """For each state, what Keep and Rerole lead to and cost, or None."""
    letter, fault = LETTERS[byte // 4], byte % 4
    if fault >= BLANK:
        return ((None, None),) * 4
    more = TRUNCATED if fault == CUT else 0
    after = AFTER.get(letter, {})
    return tuple(((after[s], more) if s in after else None, (NEXT[s], REROLE + more)) for s in range(4))


EDITS = [_edits(byte) for byte in range(16)]


def backward(byte: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """The costs before a turn from those behind it."""
    best = [DELETE + c for c in costs]
    for s, edits in enumerate(EDITS[byte]):
        for edit in edits:
            if edit and costs[edit[0]] + edit[1] < best[s]:
                best[s] = costs[edit[0]] + edit[1]
    u, a = min(best[USER], INSERT + best[ASSISTANT]), min(best[ASSISTANT], INSERT + best[USER])
    return min(best[START], INSERT + u), min(best[SYSTEM], INSERT + u), u, a


def repaired(turns: bytes) -> tuple[int, str]:
    """Cost and letters of the cheapest edits, of those the least in ASCII."""
    step = isqrt(len(turns)) + 1
    costs, checkpoints = AT_END, []
    for start in range((len(turns) - 1) // step * step, -1, -step) if turns else ():
        checkpoints.append(costs)
        for byte in reversed(turns[start : start + step]):
            costs = backward(byte, costs)
    letters, state = [], START
    total = costs[START]
    for start in range(0, len(turns), step):
        block, ahead = turns[start : start + step], [checkpoints.pop()]
        for byte in reversed(block):
            ahead.append(backward(byte, ahead[-1]))
        now = ahead.pop()
        for byte in block:
            behind = ahead.pop()
            while True:
                if DELETE + behind[state] == now[state]:
                    letters.append("D")
                    break
                if INSERT + now[NEXT[state]] == now[state]:
                    letters.append("I")
                    state = NEXT[state]
                    continue
                keep, rerole = EDITS[byte][state]
                if keep and behind[keep[0]] + keep[1] == now[state]:
                    letters.append("K")
                    state = keep[0]
                    break
                letters.append("R")
                state = rerole[0]
                break
            now = behind
    while AT_END[state]:
        letters.append("I")
        state = NEXT[state]
    return total, "".join(letters)


class Writer:
    """The repaired turns of one conversation, as its audit is followed."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.digest, self.none = hashlib.sha256(), True

    def put(self, role: str, text: str) -> None:
        self.digest.update(("" if self.none else "\n").encode() + f"{role}:{text}".encode())
        self.none = False

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            self.put(ROLES[self.state], "")

    def turn(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = AFTER[role[0]][self.state]
            self.put(role, text)
        elif edit == "R":
            self.state = NEXT[self.state]
            self.put(ROLES[self.state], text)

    def end(self) -> str:
        self.inserted()
        return self.digest.hexdigest()


def as_they_are(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of each row; nulls are one space."""
    return turns.select(
        turns["conv_id"].alias("conv_id"),
        turns["turn"].alias("turn"),
        F.coalesce(turns["role"], F.lit(" ")).alias("role"),
        F.coalesce(turns["text"], F.lit(" ")).alias("text"),
        F.lit(1).alias("copies"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """The same with damage chosen by a checksum of conv_id and turn. Fixed rule of the check query:
    a row is dropped (no copy), emptied, loses its stops, is repeated, or gets the role user."""
    rows = as_they_are(turns)
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    rows = rows.withColumn("damage", F.crc32(F.concat(conv, F.lit(":"), turn)) % 20)
    kind = F.col("damage")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _digest() -> F.Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


ORDER = ("turn", "role", "digest")


def narrow(rows: DataFrame) -> DataFrame:
    """A row for equal turns of one number: conv_id, turn, role, digest, byte of the first of them, how
    many, and whether an earlier turn of the conversation is equal. Dropped rows count 0."""
    bare = F.rtrim("text", F.lit(SPACES))
    last = F.substring(bare, -1, 1)
    fault = F.when(bare == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(WHOLE)
    letter = F.coalesce(*[F.when(F.substring("role", 1, 1) == x, k) for k, x in enumerate(LETTERS) if k], F.lit(0))
    there = F.col("copies") > 0
    turns = (
        rows.select(
            "conv_id",
            F.when(there, F.col("turn")).alias("turn"),
            F.when(there, F.col("role")).alias("role"),
            F.when(there, _digest()).alias("digest"),
            F.when(there, letter * 4 + fault).otherwise(0).alias("byte"),
            "copies",
        )
        .groupBy("conv_id", "turn", "role", "digest", "byte")
        .agg(F.sum("copies").alias("copies"))
    )
    turns = stable(turns)
    again = (
        turns.where("copies > 0")
        .groupBy(F.col("conv_id").alias("same_conv"), F.col("digest").alias("same"))
        .agg(
            F.min("turn").alias("first_turn"),
            F.max(F.col("turn").isNull()).alias("none_first"),
            F.count(F.lit(1)).alias("times"),
        )
        .where("times > 1")
    )
    joined = turns.join(
        again, (F.col("digest") == F.col("same")) & F.col("conv_id").eqNullSafe(F.col("same_conv")), "left"
    )
    earlier = F.when(F.col("none_first"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first_turn"))
    return joined.select(
        "conv_id", *ORDER, "byte", "copies", F.coalesce(earlier, F.lit(False)).alias("earlier")
    )


def blocks(turns: DataFrame) -> DataFrame:
    """The bytes of each conversation in order, in blocks numbered by task and place; first and last
    turn number of a block (null if all are) and how many different ones."""
    keys = [F.col("conv_id").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ORDER]]
    ordered = turns.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = ordered.select("conv_id", "turn", "byte", "copies", "earlier")
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = T.StructType.fromDDL(
        f"conv_id {kind}, place long, bytes binary, first long, last long, n_turns long"
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = TaskContext.get().partitionId() << 33
        conv, held, first, last, n = None, None, None, None, 0
        out: list[tuple] = []

        def made():
            columns = zip(*out, strict=True) if out else [[] for _ in arrow]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

        def close():
            nonlocal place, held
            if held is not None:
                out.append((conv, place, bytes(held), first, last, n))
                place += 1
            held = None

        for batch in batches:
            for own, turn, byte, copies, earlier in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or own != conv or len(held) >= BLOCK:
                    close()
                    conv, held, first, last, n = own, bytearray(), None, None, 0
                if copies and turn is not None and turn != last:
                    first, last, n = turn if first is None else first, turn, n + 1
                again = byte if byte % 4 == BLANK else byte // 4 * 4 + DUPLICATE
                if copies:
                    held.append(again if earlier else byte)
                    for start in range(1, copies, BLOCK):
                        held += bytes([again]) * min(BLOCK, copies - start)
            if len(out) >= BLOCK:
                yield made()
                out.clear()
        close()
        yield made()

    return ordered.mapInArrow(run, schema)


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LETTER_OF = bytes(min(byte, 15) // 4 for byte in range(256))
# Fixed value: su, ua and au may stand side by side.
LEGAL = {(1, 2), (2, 3), (3, 2)}


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, counts of faults, cost and audit of each conversation."""
    made = stable(blocks(narrow(rows)))
    one = made.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "bytes", "first", "last", "n_turns"))).alias("parts")
    )

    def make():
        def work(ids, lists):
            out = {name.split()[0]: [] for name in COUNTS.split(", ")} | {"conv_id": ids}
            for parts in lists:
                turns = b"".join([p["bytes"] for p in parts])
                numbered = [p for p in parts if p["n_turns"]]
                n = sum(p["n_turns"] for p in numbered) - sum(
                    p["last"] == q["first"] for p, q in zip(numbered, numbered[1:], strict=False)
                )
                out["gaps"].append(numbered[-1]["last"] - numbered[0]["first"] + 1 - n if numbered else 0)
                faults = [0] * 4
                letters = turns.translate(LETTER_OF)
                for byte in range(16):
                    faults[byte % 4] += turns.count(byte)
                pairs = sum(letters.count(bytes(p)) for p in LEGAL)
                out["blank"].append(faults[BLANK])
                out["duplicate"].append(faults[DUPLICATE])
                out["truncated"].append(faults[CUT])
                out["illegal"].append(max(0, len(turns) - 1) - pairs)
                cost, audit = repaired(turns)
                out["cost"].append(cost)
                out["audit"].append(audit)
            return out

        return work

    kind = rows.schema["conv_id"].dataType.simpleString()
    return per_batch(one.select("conv_id", "parts"), f"conv_id {kind}, {COUNTS}", make)


def conversations_repaired(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and the digest of the repaired turns.

    ``rows`` has conv_id, turn, role, text and copies, as `as_they_are` or `damaged` gives them."""
    names = [name.split()[0] for name in COUNTS.split(", ")]
    heads = audits(rows).select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"),
        F.lit(0).cast("long").alias("copies"), F.struct(*names).alias("head"),
    )
    texts = rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role",
        _digest().alias("digest"), "text", F.col("copies").cast("long").alias("copies"),
        F.lit(None).cast(heads.schema["head"].dataType).alias("head"),
    )
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", *ORDER)]
    stream = heads.union(texts).repartition("conv_id").sortWithinPartitions(*keys)
    schema = T.StructType.fromDDL(
        f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {COUNTS}, repaired_sha256 string"
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, row, out = None, None, []

        def made():
            columns = zip(*out, strict=True) if out else [[] for _ in arrow]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

        for batch in batches:
            for conv, kind, role, text, copies, head in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    if open_:
                        out.append((*row, open_.end()))
                    row, open_ = (conv, *[head[name] for name in names]), Writer(head["audit"])
                else:
                    for _ in range(copies):
                        open_.turn(role, text)
            if len(out) >= BLOCK:
                yield made()
                out.clear()
        if open_:
            out.append((*row, open_.end()))
        yield made()

    return stream.select("conv_id", "kind", "role", "text", "copies", "head").mapInArrow(run, schema)
