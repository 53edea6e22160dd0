"""Quality rules and robust multivariate outliers, in DataFrame functions only.

Each text gives counts; two fixed rules reject outright. The counts become a vector of five
transformed statistics. For each language and source a minimum-covariance-determinant estimate of
their centre and spread is found: from a start, the `SHARE` of the documents with the smallest
Mahalanobis distances give new means and covariances, `STEPS` times (C-steps). There are two starts:
all documents, and the documents that pass the fixed rules with the classical spread of the
centre's half; the one with the smaller determinant wins. A document whose robust distance is
above `CUT` is rejected.

All state between the steps is one row a group (means and a Cholesky factor). The documents of
smallest distance are found by exact counts of distances in fixed bins (a 64th of a doubling, so
distances in one differ by about 1 %), which are aggregated before the shuffle; a hot group costs
as many rows as others. The documents of the bin that the share ends in count with the weight that
makes up exactly the share, so determinants of one group are of equally many documents, and ties
need no order.

`FLOOR` is added to the variances, which keeps the covariance of constant statistics from vanishing.
In a group without any spread a single statistic may so differ by sqrt(`CUT`) = 6.8 times its
`FLOOR` before its document is rejected, more where the group itself is spread. Groups below
`LEAST` documents are judged by the estimate of all documents of their language, languages below
`LEAST` by that of all documents; every document has a distance.

Cases: a null text has no words and fails the base rule. Null languages and sources form groups.
Repeated rows are repeated in the result. An empty table gives an empty result. Other columns
aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwell.llm.common import SPACE, stable

SHARE = 0.75
STEPS = 4
LEAST = 50
#: Squared distance; the chi-square of five degrees exceeds it with a chance of about 1e-8.
CUT = 46.0
#: Share of the variance of a five-dimensional normal that its nearest three quarters show.
CONSISTENCY = 1.41
FLOOR = (0.6, 0.12, 0.35, 0.1, 0.1)
NAMES = tuple("abcde")
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts of each row.

    Three-word windows are compared as 64-bit hashes. Windows sorted by hash show which repeat; the
    starts of those, sorted by place, show how many words they cover."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.trim(text, F.lit(BLANKS))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")
    rows = docs.select(
        "doc_id",
        "lang",
        "source",
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, SPACE))
        .alias("words"),
    )
    rows = rows.select(
        "doc_id",
        "lang",
        "source",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    spans = F.when(F.col("n_words") < 3, F.expr("array()").cast("array<struct<h:bigint,i:int>>")).otherwise(
        F.expr(
            "transform(slice(hashes, 1, greatest(size(hashes) - 2, 1)), (x, i) -> "
            "struct(xxhash64(x, hashes[i + 1], hashes[i + 2]) AS h, i AS i))"
        )
    )
    rows = rows.withColumn("sorted", F.sort_array(spans)).drop("hashes")
    rows = rows.withColumn(
        "places",
        F.expr(
            "sort_array(transform(filter(sorted, (x, k) -> (k > 0 AND x.h = sorted[k - 1].h) "
            "OR (k < size(sorted) - 1 AND x.h = get(sorted, k + 1).h)), x -> x.i))"
        ),
    ).drop("sorted")
    covered = F.expr(
        "aggregate(places, named_struct('n', 0L, 'end', 0), (s, p) -> "
        "named_struct('n', s.n + least(3, p + 3 - s.end), 'end', p + 3), s -> s.n)"
    )
    return rows.withColumn("n_repeat_words", covered).drop("places")


def vector() -> dict[str, Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "a": F.log(words),
        "b": F.log(chars / words),
        "c": F.log1p(100 * F.col("n_symbols") / chars),
        "d": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "e": F.col("n_repeat_words") / words,
    }


def estimate(rows: DataFrame, scale: float) -> DataFrame:
    """Means, Cholesky factor and log determinant of each group (g1, g2), by ``weight`` if there is one."""
    pairs = [(i, j) for i in range(5) for j in range(i + 1)]
    weight = F.col("weight") if "weight" in rows.columns else F.lit(1.0)

    def mean(column: Column) -> Column:
        return F.sum(weight * column) / F.sum(weight)

    sums = [mean(F.col(n)).alias(f"m{i}") for i, n in enumerate(NAMES)]
    sums += [mean(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s{i}{j}") for i, j in pairs]
    made = rows.groupBy("lang", "source").agg(*sums)
    made = made.withColumns(
        {
            f"s{i}{j}": (F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * scale
            + (FLOOR[i] ** 2 if i == j else 0.0)
            for i, j in pairs
        }
    )
    for i in range(5):
        for j in range(i + 1):
            rest = F.col(f"s{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            made = made.withColumn(
                f"l{i}{j}",
                F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"),
            )
    logdet = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, 5)), F.log(F.col("l00")))
    return made.select(
        F.col("lang").alias("g1"),
        F.col("source").alias("g2"),
        *[f"m{i}" for i in range(5)],
        *[f"l{i}{j}" for i, j in pairs],
        logdet.alias("logdet"),
    )


def with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance d2 (null without an estimate of their group)."""
    found = rows.join(
        estimates,
        F.col("lang").eqNullSafe(F.col("g1")) & F.col("source").eqNullSafe(F.col("g2")),
        "left",
    )
    total = None
    for i, name in enumerate(NAMES):
        rest = F.col(name) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        found = found.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
        square = F.col(f"y{i}") * F.col(f"y{i}")
        total = square if total is None else total + square
    return found.withColumn("d2", total).select(*rows.columns, "d2", "logdet")


def nearest(rows: DataFrame, share: float) -> DataFrame:
    """Of each group the ``share`` of rows with the smallest d2. Their ``weight`` is one, but for the
    last bin, whose rows share what is left; a group's weights add up to ``share`` times its rows."""
    binned = rows.withColumn("bin", F.floor(64 * F.log2(F.col("d2") + 1e-6)).cast("int"))
    sizes = binned.groupBy("lang", "source", "bin").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("lang", "source")
    before = F.sum("n").over(group.orderBy("bin")) - F.col("n")
    wanted = share * F.sum("n").over(group) - before
    cuts = (
        sizes.withColumn("wanted", wanted)
        .where("wanted > 0")
        .groupBy(F.col("lang").alias("c1"), F.col("source").alias("c2"))
        .agg(F.max(F.struct("bin", F.least(F.lit(1.0), F.col("wanted") / F.col("n")).alias("part"))).alias("last"))
    )
    cuts = stable(cuts)
    weight = F.when(F.col("bin") < F.col("last.bin"), 1.0).otherwise(F.col("last.part"))
    return binned.join(
        cuts, F.col("lang").eqNullSafe(F.col("c1")) & F.col("source").eqNullSafe(F.col("c2"))
    ).where("bin <= last.bin").select(*rows.columns, weight.alias("weight"))


def levels(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """For each group (n1, n2) whose documents judge it: its own (level 0), its language's (1), all (2)."""
    sizes = rows.groupBy(F.col("lang").alias("n1"), F.col("source").alias("n2")).agg(
        F.count(F.lit(1)).alias("n")
    )
    of_lang = F.sum("n").over(Window.partitionBy("n1"))
    sizes = sizes.withColumn("of_lang", of_lang)
    level = F.when(F.col("n") >= least, 0).when(F.col("of_lang") >= least, 1).otherwise(2)
    return stable(sizes.select("n1", "n2", level.alias("level")))


def keyed(rows: DataFrame, level: Column) -> DataFrame:
    """``rows`` with the group of that level as lang and source."""
    return rows.withColumns(
        {
            "lang": F.struct(level.alias("level"), F.when(level < 2, F.col("lang")).alias("lang")),
            "source": F.when(level < 1, F.col("source")),
        }
    )


def with_level(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(
        found, F.col("lang").eqNullSafe(F.col("n1")) & F.col("source").eqNullSafe(F.col("n2"))
    ).drop("n1", "n2")


def pooled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of each group that has an estimate, keyed; those of a language or of all only if a
    small group needs them."""
    rows = rows.select("lang", "source", "base_failed", *NAMES)
    pool = keyed(with_level(rows, found).where("level = 0").drop("level"), F.lit(0))
    tails = found.where("level = 1").select("n1").distinct()
    inside = rows.join(tails, F.col("lang").eqNullSafe(F.col("n1")), "left_semi")
    pool = pool.union(keyed(inside, F.lit(1)))
    if not found.where("level = 2").isEmpty():
        pool = pool.union(keyed(rows, F.lit(2)))
    return stable(pool)


def estimates(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """The estimate of each group; ``rows`` has lang, source, base_failed and the vector."""
    found = None
    for start in (rows, rows.where("not base_failed")):
        now = stable(estimate(start, 1.0))
        for _ in range(steps):
            inside = nearest(with_distance(rows, now).where("d2 is not null").drop("logdet"), share)
            now = stable(estimate(inside, CONSISTENCY))
        now = now.withColumn("start", F.lit(0 if found is None else 1))
        found = now if found is None else found.union(now)
    best = Window.partitionBy("g1", "g2").orderBy("logdet", "start")
    return stable(found.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank", "start"))


def judged(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """The counts of each row, base_failed, distance (squared) and kept."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stable(counts(docs).withColumn("base_failed", base).withColumns(vector()))
    found = levels(rows)
    own = with_level(rows, found).withColumns({"own_lang": F.col("lang"), "own_source": F.col("source")})
    made = with_distance(keyed(own, F.col("level")), estimates(pooled(rows, found)))
    return made.select(
        "doc_id",
        F.col("own_lang").alias("lang"),
        F.col("own_source").alias("source"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.col("d2").alias("distance"),
        (~F.col("base_failed") & (F.col("d2") <= cut)).alias("kept"),
    )
