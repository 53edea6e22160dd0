"""The merge and its policies."""

import random

import pytest
from helpers import plan, rows

from tierwell import absent_rows, first_per_key, insert_if_absent
from tierwell.operators.merge import with_place

SOURCE = [(1, "a"), (1, "a2"), (None, "n"), (2, "b")]


def table(spark, data):
    return spark.createDataFrame(data, "ID int, V string")


def test_literal_merge_of_all_history_grows(spark):
    raw, trusted, sizes = [], [], []
    for _ in range(4):
        raw = raw + SOURCE
        trusted = rows(insert_if_absent(table(spark, raw), table(spark, trusted), ["ID"]))
        sizes.append((len(raw), len(trusted), sum(r[0] is None for r in trusted)))
    assert sizes == [(4, 4, 1), (8, 6, 3), (12, 9, 6), (16, 13, 10)]


def test_literal_merge_takes_both_copies_after_a_crash(spark):
    assert absent_rows(table(spark, SOURCE * 2), table(spark, []), ["ID"]).count() == 8


def test_safe_merge_does_not_grow(spark):
    raw, trusted = [], []
    for load in range(4):
        raw = raw + [(*r, load, i) for i, r in enumerate(SOURCE)]
        source = spark.createDataFrame(raw, "ID int, V string, load int, place int")
        merged = insert_if_absent(
            source,
            table(spark, trusted),
            ["ID"],
            null_keys="reject",
            source_duplicates="first",
            order_by=["load", "place"],
        )
        trusted = rows(merged)
        assert sorted(trusted) == [(1, "a"), (2, "b")]


def test_existing_rows_are_never_changed(spark):
    merged = insert_if_absent(table(spark, [(1, "new")]), table(spark, [(1, "old")]), ["ID"])
    assert rows(merged) == [(1, "old")]


@pytest.mark.parametrize("seed", [50, 51])
@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("null_keys", ["insert", "reject"])
@pytest.mark.parametrize("duplicates", ["keep", "first"])
def test_every_plan_matches_brute_force(
    spark, broadcast, null_keys, duplicates, seed, request
):
    """Two-column keys, two of them hot, one known and one not; nulls in either column."""
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    rng = random.Random(seed)

    def key():
        a = rng.choice([1, 2, rng.randrange(40), rng.randrange(40)])
        b = rng.choice(["x", "x", "y", None]) if a not in (1, 2) else "x"
        return (None if rng.random() < 0.1 else a, b)

    source = [(*key(), i) for i in range(600)]
    target = [r for r in ((*key(), -i) for i in range(200)) if r[0] != 1]
    known = {r[:2] for r in target if None not in r[:2]}
    expected, seen = [], set()
    for row in source:
        if None in row[:2]:
            if null_keys == "insert":
                expected.append(row)
        elif row[:2] not in known and not (duplicates == "first" and row[:2] in seen):
            seen.add(row[:2])
            expected.append(row)

    ddl = "a int, b string, place int"
    absent = absent_rows(
        spark.createDataFrame(source, ddl).repartition(5),
        spark.createDataFrame(target, ddl),
        ["a", "b"],
        null_keys=null_keys,
        source_duplicates=duplicates,
        order_by=["place"],
    )
    assert sorted(rows(absent), key=lambda r: r[2]) == expected


def test_first_per_key_keeps_rows_without_a_key_and_column_order(spark):
    df = spark.createDataFrame(
        [("p", 2, 1), ("q", 1, 1), ("r", 3, None), ("s", 4, None), ("t", None, 2)],
        "v string, place int, k int",
    )
    first = first_per_key(df, ["K"], ["place"])
    assert first.columns == ["v", "place", "k"]
    assert sorted(r[0] for r in rows(first)) == ["q", "r", "s", "t"]


def test_bad_policies_are_refused(spark):
    df = table(spark, SOURCE)
    for policy in ({"null_keys": "x"}, {"source_duplicates": "x"}, {"source_duplicates": "first"}):
        with pytest.raises(ValueError):
            absent_rows(df, df, ["ID"], **policy)


# --- rows fetched by place -----------------------------------------------------------------------


@pytest.fixture
def parts(spark):
    """Two loads of two files, keys repeated within and across them, some null."""
    rows = [
        (load, f"f{file}", (file << 40) + i if file else i, None if i % 11 == 0 else (i * 7 + load) % 40, f"{load}{file}{i}")
        for load in (1, 2) for file in (1, 0) for i in range(60)
    ]
    return spark.createDataFrame(rows, "load int, file string, arrival long, k int, v string").repartition(5)


@pytest.mark.parametrize("null_keys", ["insert", "reject"])
def test_first_by_place_is_the_first_in_order(spark, parts, null_keys):
    order = ["load", "file", "arrival"]
    target = spark.range(0, 40, 3).selectExpr("cast(id AS int) AS k")
    options = {"keys": ["k"], "null_keys": null_keys, "source_duplicates": "first"}
    by_order = absent_rows(parts, target, order_by=order, **options)
    placed = with_place(parts, order[:-1], order[-1])
    assert placed.select("_place").distinct().count() == parts.count()
    by_place = absent_rows(placed, target, place="_place", **options)
    assert sorted(map(repr, rows(by_place.drop("_place")))) == sorted(map(repr, rows(by_order)))
    assert by_order.count() > 20


def test_first_by_place_sorts_nothing(spark, parts, no_broadcast):
    placed = with_place(parts, ["load", "file"], "arrival")
    target = spark.range(5).selectExpr("cast(id AS int) AS k")
    made = absent_rows(placed, target, ["k"], "reject", "first", place="_place")
    text = plan(made)
    text = text[text.index("Physical Plan") :]
    assert "SortAggregate" not in text and "ShuffledHashJoin" in text
    assert made.count() == 35


def test_first_needs_an_order(spark, parts):
    with pytest.raises(ValueError, match="order_by or place"):
        absent_rows(parts, parts, ["k"], source_duplicates="first")


def test_first_by_place_aggregates_rows_of_fixed_width_whole(spark, parts, no_broadcast):
    """One scan and one shuffle of the source, no sort, and the rows that the order gives."""
    narrow = parts.selectExpr("load", "xxhash64(file) AS file", "arrival", "k", "IF(v < 'm', NULL, load) AS w")
    order = ["load", "file", "arrival"]
    target = spark.range(5).selectExpr("cast(id AS int) AS k")
    placed = with_place(narrow, order[:-1], order[-1])
    made = absent_rows(placed, target, ["k"], "insert", "first", place="_place")
    by_order = absent_rows(narrow, target, ["k"], "insert", "first", order_by=order)
    assert sorted(map(repr, rows(made.drop("_place")))) == sorted(map(repr, rows(by_order)))
    text = plan(absent_rows(placed, target, ["k"], "reject", "first", place="_place"))
    text = text[text.index("Physical Plan") :]
    assert "min_by" in text and "SortAggregate" not in text and "LeftSemi" not in text
    assert text.count("Exchange hashpartitioning(k") == 2
