"""Mixing sources to target weights by systematic sampling.

Sources, in code-point order and null last, weigh 1, 2, 3 and so on in turn, and share the words of
all documents by weight; no target exceeds `cap` times its source's words, and what is left over is
shared again by weight among the others. A document's expected copies are its source's target over
its words. They are summed up within the source in an order of its own, one offset is added, and a
document is taken once for each whole number its part of the sum crosses.

Documents are put in order by size class (a sixteenth of a doubling) and then by the digest of
doc_id, so copies are spread evenly over the sizes and the words taken come near the target. The
prefix sum runs in two steps: sums of blocks of about `BLOCK` documents, which any class of a hot
source is cut into by digest, then sums within the blocks. Sums are whole numbers of 2**-20 copies:
their order doesn't matter, and a run again gives the same rows. The offset is taken from the
source's digest.

Cases: a null or blank text has size 0 and takes no words. Null sources are a source. Repeated rows are documents of their own. With no words at all every
target is 0. An empty table gives an empty result. Other columns are carried along in a struct, so
their names can't clash with the helpers'. Rows without a doc_id are put in order by a hash of the row, as
are rows of one doc_id, so the mix doesn't depend on how the rows are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwell.llm.common import WORD, quoted, stable

CAP = 3
BLOCK = 16_384
UNIT_BITS = 20
UNIT = 1 << UNIT_BITS


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Grows with the size: the size below 32, then its bit length and the four bits that follow."""
    bits = F.length(F.bin(size))
    upper = F.expr("shiftright(mix_size, length(bin(mix_size)) - 5)").bitwiseAND(F.lit(15))
    return F.when(size < 32, size.cast("int")).otherwise(bits * 16 + upper.cast("int"))


def targets(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """mix_source, mix_words and mix_target of each row of (mix_source, mix_words).

    Sources are put in order by the share of weight at which they meet their cap. The first that
    doesn't meet it, when all before it have, gives the words a unit of weight gets. The windows run
    over one row a source.
    """
    by_name = Window.orderBy(F.col("mix_source").isNull(), "mix_source")
    weighed = sizes.withColumn("mix_weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    everything = Window.partitionBy()
    by_cap = Window.orderBy(
        F.col("mix_words") * cap / F.col("mix_weight"), F.col("mix_source").isNull(), "mix_source"
    )
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)

    def left(name, factor=1):
        spent = F.coalesce(F.sum(name).over(before), F.lit(0))
        return F.sum(name).over(everything) - spent * factor

    shared = weighed.withColumn(
        "mix_share", left("mix_words", cap).cast("double") / left("mix_weight").cast("double")
    )
    open_ = F.col("mix_share") * F.col("mix_weight") <= F.col("mix_words") * cap
    level = F.min(F.when(open_, F.struct("mix_place", "mix_share"))).over(everything)["mix_share"]
    return shared.withColumn("mix_place", F.row_number().over(by_cap)).select(
        "mix_source",
        "mix_words",
        F.least(
            (F.col("mix_words") * cap).cast("double"), level * F.col("mix_weight")
        ).alias("mix_target"),
    )


def _taken(docs: DataFrame, size: str | None, source: str, cap: int, seed: str) -> DataFrame:
    """Each row of ``docs`` as the struct mix_row, with mix_size, mix_words, mix_target and mix_copies."""
    own = {c: F.col(quoted(c)) for c in docs.columns}
    others = [c for name, c in own.items() if name != "text"]
    # Rows with equal ties are alike, so it doesn't matter which of them is taken.
    tie = F.xxhash64(F.to_json(F.struct(*others)), *([own["text"]] if "text" in own else []))
    rows = docs.select(
        F.struct(*own.values()).alias("mix_row"),
        (own[size].cast("long") if size else word_count(own["text"])).alias("mix_size"),
        own[source].alias("mix_source"),
        own["doc_id"].alias("mix_id"),
        tie.alias("mix_tie"),
    )
    rows = rows.withColumns(
        {
            "mix_class": size_class(F.col("mix_size")),
            "mix_digest": F.md5(F.coalesce(F.col("mix_id").cast("string"), F.hex("mix_tie"))),
        }
    )
    classes = stable(
        rows.groupBy("mix_source", "mix_class").agg(
            F.count(F.lit(1)).alias("mix_rows"), F.sum("mix_size").alias("mix_words")
        )
    )
    goals = targets(classes.groupBy("mix_source").agg(F.sum("mix_words").alias("mix_words")), cap)
    units = F.floor(F.col("mix_target") / F.col("mix_words") * UNIT + 0.5).cast("long")
    offset = F.conv(
        F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("mix_source", F.lit("")))), 1, 5), 16, 10
    ).cast("long")
    plan = classes.select(
        F.col("mix_source").alias("s"),
        F.col("mix_class").alias("c"),
        F.ceil(F.col("mix_rows") / BLOCK).alias("mix_blocks"),
    )
    goals = goals.select(
        F.col("mix_source").alias("s2"),
        "mix_words",
        "mix_target",
        F.when(F.col("mix_words") > 0, units).otherwise(F.lit(0).cast("long")).alias("mix_units"),
        offset.alias("mix_offset"),
    )
    plan = stable(plan.join(goals, F.col("s").eqNullSafe(F.col("s2"))).drop("s2"))
    rows = rows.join(
        plan, F.col("mix_source").eqNullSafe(F.col("s")) & (F.col("mix_class") == F.col("c"))
    ).drop("s", "c")
    part = F.conv(F.substring("mix_digest", 1, 8), 16, 10).cast("long") * F.col("mix_blocks")
    rows = rows.withColumn("mix_block", F.shiftright(part, 32))
    block = ["mix_source", "mix_class", "mix_block"]
    along = Window.partitionBy("mix_source").orderBy("mix_class", "mix_block")
    blocks = rows.groupBy(*block).agg(F.sum("mix_units").alias("mix_sum"))
    blocks = stable(
        blocks.select(
            *[F.col(c).alias(f"k{i}") for i, c in enumerate(block)],
            (F.sum("mix_sum").over(along) - F.col("mix_sum")).alias("mix_before"),
        )
    )
    rows = rows.join(
        blocks,
        F.col("mix_source").eqNullSafe(F.col("k0"))
        & (F.col("mix_class") == F.col("k1"))
        & (F.col("mix_block") == F.col("k2")),
    ).drop("k0", "k1", "k2")
    inside = Window.partitionBy(*block).orderBy("mix_digest", "mix_id", "mix_size", "mix_tie")
    upto = (
        F.col("mix_before")
        + F.sum("mix_units").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        + F.col("mix_offset")
    )
    crossed = F.shiftright(upto, UNIT_BITS) - F.shiftright(upto - F.col("mix_units"), UNIT_BITS)
    return rows.withColumn("mix_copies", crossed).select("mix_row", *MADE)


MADE = ("mix_size", "mix_words", "mix_target", "mix_copies")


def copied(
    docs: DataFrame, source: str = "source", cap: int = CAP, seed: str = "mix", size: str | None = None
) -> DataFrame:
    """The rows of ``docs`` with mix_size, mix_words (of the source), mix_target and mix_copies, in place
    of columns that have these names already.

    ``docs`` has doc_id, the source, and text or the column ``size`` with the words of each."""
    made = _taken(docs, size, source, cap, seed)
    kept = [c for c in docs.columns if c.lower() not in MADE]
    return made.select(*[F.col("mix_row")[c].alias(c) for c in kept], *MADE)


def mixed(
    docs: DataFrame, source: str = "source", cap: int = CAP, seed: str = "mix", size: str | None = None
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    taken = _taken(docs, size, source, cap, seed).where("mix_copies > 0")
    again = F.explode(F.array_repeat(F.lit(1), F.col("mix_copies").cast("int")))
    return taken.select("mix_row", again.alias("mix_copy")).select("mix_row.*")


#: The same in one window over each source.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS words,
    (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
shared AS (
  SELECT *, row_number() OVER by_cap AS place,
    (sum(words) OVER () - 3 * coalesce(sum(words) OVER before, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS share
  FROM sources
  WINDOW by_cap AS (ORDER BY (3 * words)::DOUBLE / weight, source IS NULL, encode(source)),
    before AS (ORDER BY (3 * words)::DOUBLE / weight, source IS NULL, encode(source)
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min(share, place) AS share FROM shared WHERE share * weight <= 3 * words),
goals AS (
  SELECT source, words, least((3 * words)::DOUBLE, level.share * weight) AS target,
    CASE WHEN words > 0 THEN
      floor(least((3 * words)::DOUBLE, level.share * weight) / words * 1048576 + 0.5)::BIGINT
    ELSE 0 END AS units,
    ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 5))::BIGINT AS shift
  FROM shared, level),
placed AS (
  SELECT s.doc_id, s.size, g.words, g.target, g.units,
    g.shift + g.units * row_number() OVER (PARTITION BY s.source ORDER BY
      CASE WHEN s.size < 32 THEN s.size
        ELSE length(bin(s.size)) * 16 + ((s.size >> (length(bin(s.size)) - 5)::INT) & 15) END,
      s.digest, s.doc_id NULLS FIRST, s.size) AS upto
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, words AS source_size, target,
  size * ((upto >> 20) - ((upto - units) >> 20)) AS taken
FROM placed
"""
