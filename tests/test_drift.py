"""Records whose fields change type: the merged schema, type counts and choices."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.operators import drift


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "n int, text string").withColumn("r", F.try_parse_json("text"))


def test_schema_merges_in_any_order(spark):
    texts = ['{"a":1,"b":{"c":1}}', '{"a":2.5,"b":{"d":"x"}}', '{"b":{"c":"y"},"e":[1,2]}', '{"e":[3],"we ird.x`":true}', "[1]", "7", None, "null"]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(texts)
        got = drift.common_schema(table(spark, texts), "r").simpleString()
        want = want or got
        assert got == want
    assert "c:variant" in want and "e:array<bigint>" in want and "d:string" in want


def test_counts_equal_plain_python(spark):
    rnd = random.Random(6)
    value = lambda d=0: rnd.choice([1, 2.5, "s", True, None, [1, "x"], {"in": value(d + 1), "x y": 1} if d < 2 else 0])
    docs = [{k: value() for k in rnd.sample("abcd", rnd.randrange(5))} for _ in range(200)]
    want = {}

    def walk(path, v):
        kind = {int: "integer", float: "fraction", str: "string", bool: "boolean", type(None): "null", list: "array", dict: "object"}[type(v)]
        want[path, kind] = want.get((path, kind), 0) + 1

    merged = drift.common_schema(table(spark, [json.dumps(d) for d in docs]), "r")
    paths = {p for p, _ in drift.fields_of(merged)}
    for doc in docs:
        for path in paths:
            at = doc
            for name in path:
                at = at.get(name, ...) if isinstance(at, dict) else ...
            if at is not ...:
                walk(".".join(path), at)
    got = drift.type_counts(table(spark, [json.dumps(d) for d in docs]), "r").collect()
    assert {(r.path, r.kind): r.rows for r in got} == want


def test_each_way_to_resolve(spark):
    df = table(spark, ['{"k":1,"o":{"v":1}}', '{"k":"2","o":{"v":[1,"x"]}}', '{"k":null,"o":3}', '{"k":{"z":1}}', "[]", None, '{"k":true,"it\'s":1}'])
    got = drift.resolve(df, "r", ["n"])
    assert got.columns == ["n", "it's", "k", "o"]
    k = {r.n: r.k.asDict() for r in got.collect()}
    none = dict.fromkeys(["long", "string", "boolean", "object"])
    assert k[0] == none | {"long": 1} and k[1] == none | {"string": "2"} and k[2] == none and k[3] == none | {"object": '{"z":1}'} and k[6] == none | {"boolean": True} and k[5] == none
    by = lambda how: {r.n: r.k for r in drift.resolve(df, "r", ["n"], how).collect()}
    assert by("json") == {0: "1", 1: '"2"', 2: "null", 3: '{"z":1}', 4: None, 5: None, 6: "true"}
    assert by({"k": "cast:bigint"}) == {0: 1, 1: 2, 2: None, 3: None, 4: None, 5: None, 6: 1}
    assert by({"k": "project:string"}) == {0: None, 1: "2", 2: None, 3: None, 4: None, 5: None, 6: None}
    with pytest.raises(ValueError):
        drift.resolve(df, "r", [], "what")


def test_nothing_drifts(spark):
    df = table(spark, ['{"a":1,"b":{"c":"x"},"l":[{"p":1}]}', '{"a":2}'])
    assert drift.choices_of(df, "r", drift.common_schema(df, "r")) == {}
    assert [r.asDict(True) for r in drift.resolve(df, "r", []).collect()] == [{"a": 1, "b": {"c": "x"}, "l": [{"p": 1}]}, {"a": 2, "b": None, "l": None}]
    empty = table(spark, ["[]", None])
    assert drift.resolve(empty, "r", ["n"]).columns == ["n"] and drift.type_counts(empty, "r").collect() == []
    assert rows(drift.resolve(df.limit(0), "r", ["n"])) == []
