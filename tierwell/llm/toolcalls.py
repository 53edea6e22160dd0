"""Tool-call linking: calls and results are joined by identifier, put in topological order, checked
against schemas and written as canonical JSON.

A call has conv_id, call_id, name, arguments (JSON text) and after (the call_id it waits for, or
null); a result has conv_id, call_id and content. Exact repeats are one row with a count. Of the
differing calls and of the differing results of an identifier each has a rank: the smallest 1, nulls
last, the others in order of a hash. All of them have records: each call with the identifier's first
result, and each further result with its first call. So a hot identifier costs as many rows as
it has different calls and results, and those are ranked and joined in `SALTS` parts.

A call's level is the number of calls it waits for in turn, the longest way where an identifier's
calls wait for different ones, found by doubling the length of the ways: rounds grow with the
logarithm of the longest chain, and no conversation is gathered in one place. Order by (level,
call_id) is topological.

status: ok; no_result; invalid (arguments that aren't an object of the schema, or a name without
one); cycle (the call waits for itself; level null); orphan (a result without a call). A call that
waits for an unknown call has level 0.

Cases: rows without conv_id or call_id can't be linked and are left out. Null names, arguments and
contents are invalid or null in the record. Arguments that are no JSON, hold NaN or a number beyond
all bounds, or are nested too deep, are text in the record and invalid. A schema that says what can't be
checked is refused before the job. Empty tables give an empty result; other columns aren't
read.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwell.llm.common import per_batch, stable

SALTS = 64
ID = ["conv_id", "call_id"]

KINDS = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


LONE = re.compile("[\ud800-\udfff]")

# What a schema may say of a value, and of which kinds of value it says it.
BOUNDS = {
    "minLength": (str, lambda v, n: len(v) >= n),
    "maxLength": (str, lambda v, n: len(v) <= n),
    "minimum": ((int, float), lambda v, n: v >= n),
    "maximum": ((int, float), lambda v, n: v <= n),
    "minItems": (list, lambda v, n: len(v) >= n),
    "maxItems": (list, lambda v, n: len(v) <= n),
}
WORDS = {"type", "enum", "properties", "required", "additionalProperties", "items", *BOUNDS}


def canonical(value) -> str:
    """JSON with sorted keys, without spaces, in UTF-8; halves of surrogate pairs stay escaped."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return LONE.sub(lambda half: f"\\u{ord(half[0]):04x}", text)


def no_number(name: str):
    raise ValueError(f"{name} is no JSON")


def parsed(text: str | None):
    """The value of JSON text, and the text itself if it is none: not JSON, a number beyond all bounds, or
    nested too deep to be read or written."""
    if text is None:
        return None
    try:
        value = json.loads(text, parse_constant=no_number)
        canonical(value)
    except (ValueError, RecursionError):
        return text
    return value


def checked(schema: dict) -> dict:
    """The schema, if `valid` can apply all it says; else a ValueError."""
    if not isinstance(schema, dict) or not schema.keys() <= WORDS:
        raise ValueError(f"schema {schema!r} says more than can be checked")
    kinds = schema.get("type", [])
    if not set([kinds] if isinstance(kinds, str) else kinds) <= KINDS.keys():
        raise ValueError(f"schema type {kinds!r} is unknown")
    inner = [*schema.get("properties", {}).values(), *[schema[w] for w in ("items", "additionalProperties") if w in schema]]
    for one in inner:
        if not isinstance(one, bool):
            checked(one)
    return schema


def valid(value, schema: dict) -> bool:
    """Whether a JSON value is as the schema says: type (one or several), enum, bounds, and for objects
    and arrays properties, required, additionalProperties (false, or a schema) and items."""
    kinds = schema.get("type")
    if kinds is not None and not any(KINDS[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return False
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        return False
    for word, (kind, holds) in BOUNDS.items():
        if word in schema and isinstance(value, kind) and not isinstance(value, bool) and not holds(value, schema[word]):
            return False
    if isinstance(value, dict):
        properties, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        if any(name not in value for name in schema.get("required", ())):
            return False
        for name, one in value.items():
            rule = properties.get(name, more)
            if rule is False or (isinstance(rule, dict) and not valid(one, rule)):
                return False
    items = schema.get("items", True)
    if isinstance(value, list) and isinstance(items, dict):
        return all(valid(one, items) for one in value)
    return not (isinstance(value, list) and value and items is False)


def fits(arguments, schema: dict | None) -> bool:
    """Whether a call's arguments are an object of the schema of its name."""
    return schema is not None and isinstance(arguments, dict) and valid(arguments, schema)


def ranked(rows: DataFrame, fields: list[str], prefix: str) -> DataFrame:
    """Each different row of an identifier once: ID, ``fields``, salt, and with the prefix rows (how
    often it is there), rank and n_...s (rows of the identifier)."""
    order = F.struct(*[c for f in fields for c in (F.col(f).isNull().alias(f"no_{f}"), F.col(f))])
    found = rows.where("conv_id is not null and call_id is not null").groupBy(*ID, *fields).agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows")
    )
    found = stable(found.withColumn("salt", F.pmod(F.xxhash64(*fields), F.lit(SALTS)).cast("int")))
    parts = found.groupBy(*ID, "salt").agg(
        F.count(F.lit(1)).alias("size"), F.sum(f"{prefix}_rows").alias("there"), F.min(order).alias("least")
    )
    own = Window.partitionBy(*ID)
    parts = parts.withColumns(
        {"behind": ~F.col("least").eqNullSafe(F.min("least").over(own)), f"n_{prefix}s": F.sum("there").over(own)}
    )
    before = F.sum("size").over(own.orderBy("behind", "salt")) - F.col("size")
    parts = parts.withColumn("before", before).select(*ID, "salt", "before", f"n_{prefix}s")
    place = F.row_number().over(Window.partitionBy(*ID, "salt").orderBy(order))
    made = found.join(parts, [*ID, "salt"]).withColumn(f"{prefix}_rank", F.col("before") + place)
    return stable(made.drop("before"))


def levels(calls: DataFrame) -> DataFrame:
    """``calls`` (of ranked) with level; null on cycles and behind them."""
    waits = stable(calls.select(*ID, "salt", "after").distinct())
    depth = stable(waits.select(*ID).distinct().withColumn("level", F.lit(0).cast("long")))

    def target(name: str) -> DataFrame:
        return depth.select(F.col("conv_id").alias("c"), F.col("call_id").alias("k"), F.col("level").alias(name))

    now = waits.select(*ID, "after").distinct()
    now = stable(
        now.join(target("more"), (F.col("conv_id") == F.col("c")) & (F.col("after") == F.col("k")))
        .select(*ID, F.col("after").alias("next"))
    )
    longest, total = 1, depth.count()
    while longest <= total and not now.isEmpty():  # `now`: where ways of just `longest` steps lead
        at_next = (F.col("conv_id") == F.col("c")) & (F.col("next") == F.col("k"))
        more = now.join(target("more"), at_next).groupBy(*ID).agg((F.max("more") + longest).alias("more"))
        step = now.select(F.col("conv_id").alias("c"), F.col("call_id").alias("k"), F.col("next").alias("further"))
        depth = stable(depth.join(more, ID, "left").select(*ID, F.greatest("level", "more").alias("level")))
        now = stable(now.join(step, at_next).select(*ID, F.col("further").alias("next")).distinct())
        longest *= 2
    endless = now.select(*ID).distinct().withColumn("endless", F.lit(True))
    depth = depth.join(endless, ID, "left").select(*ID, F.when(F.col("endless").isNull(), F.col("level")).alias("level"))
    found = waits.join(
        target("more"), (F.col("conv_id") == F.col("c")) & (F.col("after") == F.col("k")), "left"
    ).select(
        F.col("conv_id").alias("c1"),
        F.col("call_id").alias("k1"),
        F.col("salt").alias("s1"),
        F.col("after").alias("a1"),
        F.when(F.col("k").isNull(), 0).otherwise(F.col("more") + 1).cast("long").alias("level"),
    )
    same = (F.col("conv_id") == F.col("c1")) & (F.col("call_id") == F.col("k1")) & (F.col("salt") == F.col("s1"))
    return calls.join(found, same & F.col("after").eqNullSafe(F.col("a1"))).drop("c1", "k1", "s1", "a1")


def beside(further: DataFrame, firsts: DataFrame) -> DataFrame:
    """``further`` rows with the one row of their identifier in ``firsts``, which goes to each salt."""
    parts = further.select(*ID, "salt").distinct().join(firsts.drop("salt"), ID, "left")
    return further.join(parts, [*ID, "salt"])


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, call_id, level, status, n_calls, n_results and the canonical record of each identifier's
    first call and first result; `records` has all of them."""
    first = "coalesce(call_rank, 1) = 1 and coalesce(result_rank, 1) = 1"
    made = records(calls, results, schemas).where(first)
    return made.drop("call_rank", "call_rows", "result_rank", "result_rows")


def records(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, call_id, level, status, n_calls, n_results (rows of the identifier) and the canonical
    record of each different call and result; rank and rows of both."""
    schemas = {name: checked(schema) for name, schema in schemas.items()}
    calls = stable(levels(ranked(calls, ["name", "arguments", "after"], "call")))
    results = ranked(results, ["content"], "result")
    first_calls, first_results = calls.where("call_rank = 1"), results.where("result_rank = 1")
    both = (
        first_calls.drop("salt").join(first_results.drop("salt"), ID, "full")
        .unionByName(beside(calls.where("call_rank > 1"), first_results).drop("salt"))
        .unionByName(beside(results.where("result_rank > 1"), first_calls).drop("salt"))
    )
    kept = ["call_rank", "call_rows", "result_rank", "result_rows"]

    def make():
        def work(conv_ids, call_ids, levels_, n_calls, n_results, names, arguments, afters, contents, *others):
            out = {"status": [], "record": []}
            rows = zip(call_ids, levels_, n_calls, n_results, names, arguments, afters, contents, strict=True)
            for call_id, level, called, answered, name, text, after, content in rows:
                value = parsed(text)
                status = (
                    "orphan" if not called
                    else "cycle" if level is None
                    else "invalid" if not fits(value, schemas.get(name))
                    else "ok" if answered
                    else "no_result"
                )
                record = {"id": call_id, "status": status, "result": content}
                if called:
                    record |= {"name": name, "arguments": value, "after": after}
                out["status"].append(status)
                out["record"].append(canonical(record))
            return out | dict(zip(kept, others, strict=True)) | {
                "conv_id": conv_ids,
                "call_id": call_ids,
                "level": levels_,
                "n_calls": [n or 0 for n in n_calls],
                "n_results": [n or 0 for n in n_results],
            }

        return work

    return per_batch(
        both.select(
            "conv_id", "call_id", "level", "n_calls", "n_results", "name", "arguments", "after", "content", *kept
        ),
        "conv_id long, call_id string, level long, status string, n_calls long, n_results long, "
        "record string, call_rank long, call_rows long, result_rank long, result_rows long",
        make,
    )


# The turns of `conversations` as calls: a user's turn asks, the assistant's next turn answers.
ASK = {
    "type": "object",
    "required": ["prompt", "turn"],
    "additionalProperties": False,
    "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
}


def calls_of(turns: DataFrame) -> DataFrame:
    """A call of `ask` for each user turn; it waits for the exchange two turns before."""
    return turns.where("role = 'user'").select(
        "conv_id",
        F.concat(F.lit("t"), F.col("turn").cast("string")).alias("call_id"),
        F.lit("ask").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), "turn")).alias("arguments"),
        F.concat(F.lit("t"), (F.col("turn") - 2).cast("string")).alias("after"),
    )


def results_of(turns: DataFrame) -> DataFrame:
    return turns.where("role = 'assistant'").select(
        "conv_id",
        F.concat(F.lit("t"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        F.col("text").alias("content"),
    )


#: The same with a recursive chain and JSON put together by hand.
ORACLE = """
WITH RECURSIVE calls AS (
  SELECT conv_id, 't' || turn AS call_id, turn, 't' || (turn - 2) AS after, min(text) AS text,
    count(*) AS n_calls
  FROM conversations WHERE role = 'user' GROUP BY conv_id, turn),
results AS (
  SELECT conv_id, 't' || (turn - 1) AS call_id, min(text) AS text, count(*) AS n_results
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn),
chain AS (
  SELECT conv_id, call_id, 0::BIGINT AS level FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.after)
  UNION ALL
  SELECT c.conv_id, c.call_id, level + 1 FROM chain p
  JOIN calls c ON p.conv_id = c.conv_id AND p.call_id = c.after),
joined AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
    c.call_id IS NULL AS alone, level, turn, after, c.text AS prompt, r.text AS content,
    coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results
  FROM (SELECT * FROM calls JOIN chain USING (conv_id, call_id)) c
  FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id),
judged AS (
  SELECT *, CASE WHEN alone THEN 'orphan' WHEN coalesce(length(prompt), 0) = 0 THEN 'invalid'
    WHEN n_results > 0 THEN 'ok' ELSE 'no_result' END AS status FROM joined)
SELECT conv_id, call_id, level, status, n_calls, n_results,
  '{' || CASE WHEN alone THEN '' ELSE '"after":"' || after || '","arguments":{'
    || CASE WHEN prompt IS NULL THEN '' ELSE '"prompt":' || to_json(prompt)::VARCHAR || ',' END
    || '"turn":' || turn || '},' END
  || '"id":"' || call_id || '",'
  || CASE WHEN alone THEN '' ELSE '"name":"ask",' END
  || '"result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"status":"' || status || '"}' AS record
FROM judged
"""
