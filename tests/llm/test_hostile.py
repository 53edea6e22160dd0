"""Rows and columns that get in the way of helpers: every operator that carries rows, and the stages."""

import json

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tierwell.llm import mixing, quality, simhash, substrings, toolcalls

CLASHING = (
    "s s2 c k k0 k1 k2 a b i h n key own rest ranges cut packed no_text row_key row_hash0 node root first least same "
    "unnamed fingerprint component_id words score mark marked wanted mix_row mix_size mix_words mix_class mix_digest mix_copies "
    "mix_tie mix_id mix_block mix_before mix_source mix_target mix_copy taken doc text_hash"
).split()
ODD = ["a`b", "a.b", "two words", "ü", "Mix_Units"]


@pytest.fixture(scope="module")
def hostile(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hostile"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    none = docs.withColumn("doc_id", F.lit(None).cast("long"))
    rows = docs.unionByName(none).unionByName(docs.limit(20)).unionByName(none.withColumn("text", F.lit(None).cast("string")).limit(5))
    extra = [F.lit(k).alias(name) for k, name in enumerate([*CLASHING, *ODD])]
    rows = rows.select("*", *extra, F.create_map(F.lit("k"), F.lit(1)).alias("m"), F.array(F.struct(F.lit(1).alias("x"))).alias("deep"))
    rows.repartition(6).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def whole(df):
    return sorted(json.dumps(r.asDict(True), sort_keys=True, default=str) for r in df.collect())


def test_rows_come_back_with_their_columns(spark, hostile):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    there = set(whole(hostile))
    for carried in (
        quality.accepted(hostile, labels), simhash.without_near_copies(hostile), mixing.mixed(hostile),
        mixing.mixed(hostile.limit(0)), substrings.kept_texts(hostile.limit(0)),
    ):
        assert carried.columns == hostile.columns and carried.schema.simpleString() == hostile.schema.simpleString()
        assert set(whole(carried)) <= there
    kept = substrings.kept_texts(hostile)
    assert kept.columns == hostile.columns and kept.count() == hostile.count()
    assert {tuple(r[name] for name in [*CLASHING, *ODD]) for r in kept.collect()} == {tuple(range(len(CLASHING) + len(ODD)))}


def test_the_mix_does_not_depend_on_partitions(hostile):
    mixes = [whole(mixing.mixed(hostile.repartition(n))) for n in (1, 3, 8)]
    assert mixes[0] == mixes[1] == mixes[2] and mixes[0]


def test_size_is_taken_only_when_asked(hostile):
    made = mixing.copied(hostile)
    assert made.where(mixing.word_count(F.col("text")) != F.col("mix_size")).count() == 0
    asked = mixing.copied(hostile, size="taken")
    assert asked.select("mix_size").distinct().count() == 1
    assert [c for c in made.columns if c.startswith("mix_")][-4:] == list(mixing.MADE)


def test_stages_with_extra_columns_and_without_rows(spark, hostile):
    folder = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, hostile, folder)
        none = stage(spark, hostile.limit(0), folder)
        assert none.count() == 0 and none.columns == made.columns, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == hostile.columns


CALLS = "conv_id long, call_id string, name string, arguments string, after string"
SCHEMAS = {
    "f": {
        "type": "object",
        "properties": {
            "a": {"type": ["integer", "null"], "minimum": 0},
            "o": {"type": "object", "required": ["x"], "properties": {"x": {"enum": ["p", 1]}}, "additionalProperties": False},
            "l": {"type": "array", "items": {"type": "string", "maxLength": 2}, "maxItems": 2},
            "free": {},
        },
        "additionalProperties": {"type": "boolean"},
    }
}


def test_arguments_that_are_hard_to_read(spark):
    texts = {
        "half": ('{"free":"\\ud800"}', "ok"),
        "deep": ('{"free":' + "[" * 100_000, "invalid"),
        "deep2": ('{"free":' + "[" * 950 + "]" * 950 + "}", None),
        "nan": ('{"free":NaN}', "invalid"),
        "huge": ('{"free":1e400}', "invalid"),
        "long": ('{"free":"' + "x" * 1_000_000 + '"}', "ok"),
        "zero": ('{"a":0}', "ok"), "none": ('{"a":null}', "ok"), "low": ('{"a":-1}', "invalid"), "true": ('{"a":true}', "invalid"),
        "inner": ('{"o":{"x":"p"}}', "ok"), "inner2": ('{"o":{"x":"q"}}', "invalid"), "inner3": ('{"o":{}}', "invalid"),
        "inner4": ('{"o":{"x":1,"y":1}}', "invalid"), "items": ('{"l":["a","bb"]}', "ok"), "items2": ('{"l":["abc"]}', "invalid"),
        "items3": ('{"l":["a","b","c"]}', "invalid"), "more": ('{"z":true}', "ok"), "more2": ('{"z":1}', "invalid"),
        "list": ("[]", "invalid"), "text": ("no json", "invalid"), "nothing": (None, "invalid"),
    }
    calls = spark.createDataFrame([(1, k, "f", t, None) for k, (t, _) in texts.items()], CALLS)
    results = spark.createDataFrame([(1, k, "r") for k in texts], "conv_id long, call_id string, content string")
    made = {r.call_id: r for r in toolcalls.linked(calls, results, SCHEMAS).collect()}
    for name, (_, status) in texts.items():
        assert status in (None, made[name].status), name
        json.loads(made[name].record, parse_constant=lambda x: pytest.fail(x))
    assert json.loads(made["half"].record)["arguments"] == {"free": "\ud800"}


@pytest.mark.parametrize("schema", [{"type": "text"}, {"pattern": "x"}, {"properties": {"a": {"type": ["no"]}}}, {"items": 3}])
def test_schemas_that_cannot_be_checked_are_refused(schema):
    with pytest.raises(ValueError, match="schema"):
        toolcalls.checked(schema)
