"""Validation by rule rows against the checker of nested shapes, and the trie itself."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from viewloom.operators import quality, rules
from viewloom.operators.quality import Document, ListOf, MapOf, Scalar, Structure
from viewloom.plans.quality_queries import ORDER_SHAPE

SHAPE = Structure(
    {
        "id": Scalar("integer", min=1),
        "name": Scalar("string", min=2),
        "at": Scalar("timestamp"),
        "raw": Scalar("blob"),
        "odd name.x[0]`": Scalar("boolean"),
        "tags": ListOf(MapOf(ListOf(Scalar("double", min=0)), Scalar("string", min=2)), min=1),
        "one": Structure({"a": Scalar("string"), "b": Structure({"c": Scalar("integer")}, required=("c",))}, union=True),
        "free": Document(),
    },
    required=("id", "one"),
)


def table(spark, found):
    return spark.createDataFrame(found, rules.RULES)


def checked(spark, texts, rule_rows, feed=None):
    df = spark.createDataFrame([(i, *t) if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)], "n int, text string" + (", feed string" if feed else ""))
    df = df.withColumn("record", F.parse_json("text"))
    return rows(rules.violation_rows(df, "record", table(spark, rule_rows), ["n"], feed), "n", "path", "reason", "detail")


def value(rnd, depth=0):
    """Random JSON that often fits, and often does not."""
    kind = rnd.randrange(9 if depth < 3 else 6)
    if kind == 6:
        return "[" + ",".join(value(rnd, depth + 1) for _ in range(rnd.randrange(3))) + "]"
    if kind >= 7:
        keys = rnd.sample(["id", "name", "a", "b", "c", "x", "tags", "one", "at"], rnd.randrange(4))
        return "{" + ",".join(f'"{k}":{value(rnd, depth + 1)}' for k in keys) + "}"
    return rnd.choice(["1", "-3", "2.5", '"v"', '"word"', "true", "null", '"2024-01-02"'])


def record(rnd):
    parts = []
    for name in ("id", "name", "at", "raw", "odd name.x[0]`", "tags", "one", "free", "more"):
        if rnd.random() < 0.7:
            good = {"tags": '[{"ab":[1,-1],"c":[]},{}]', "one": '{"b":{"c":1}}', "id": "5", "at": '"2024-01-02"'}.get(name, '"v"')
            parts.append(f'"{name}":' + (good if rnd.random() < 0.5 else value(rnd)))
    return "{" + ",".join(parts) + "}"


@pytest.mark.parametrize("shape", [SHAPE, ORDER_SHAPE], ids=["nested", "orders"])
def test_rows_say_what_the_shape_says(spark, shape):
    rnd = random.Random(41)
    texts = [record(rnd) for _ in range(150)] + ["{}", "[]", "7", "null", '"x"', '{"id":null,"one":{}}', '{"tags":[{"":[1]}]}']
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").withColumn("record", F.parse_json("text"))
    want = rows(quality.violation_rows(df, "record", shape, ["n"]), "n", "path", "reason", "detail")
    got = checked(spark, texts, rules.rules_of(shape))
    assert len(want) > 100 and got == want


def test_wildcards_and_beginnings(spark):
    """Paths between the rules are what their steps make them."""
    found = [(None, "a[].b", "integer", True, 3.0), (None, "m{}.x", "string", None, None), (None, "m{key}", "string", None, 2.0)]
    nodes = {tuple(r.node): r for r in rules.trie(table(spark, found)).collect()}
    assert {k: v.type for k, v in nodes.items()} == {
        (): "structure", (".a",): "list", (".a", "[]"): "structure", (".a", "[]", ".b"): "integer",
        (".m",): "map", (".m", "{}"): "structure", (".m", "{}", ".x"): "string", (".m", "{key}"): "string",
    }
    assert nodes[".a", "[]"].needed == ["b"]
    got = checked(spark, ['{"a":[{"b":2},{"b":3},{},4],"m":{"k":{"x":1},"kk":{}}}', '{"a":{}}', '{"z":1}'], found)
    assert got == sorted(
        [
            (0, ".a[0].b", "invalid range", "2"), (0, ".a[2]", "missing required field", "b"), (0, ".a[3]", "invalid type", "integer"),
            (0, ".m (key: k)", "invalid length", '"k"'), (0, ".m.k.x", "invalid type", "integer"),
            (1, ".a", "invalid type", "object"), (2, "", "unknown field", "z"),
        ],
        key=lambda r: [str(v) for v in r],
    )


def test_feeds_have_their_own_rules(spark):
    found = [("x", "k", "integer", True, None), ("y", "k", "string", False, None), (None, "k", "boolean", False, None)]
    texts = [('{"k":1}', "x"), ('{"k":1}', "y"), ("{}", "x"), ('{"k":1}', None), ('{"k":1}', "unknown")]
    assert checked(spark, texts, found, "feed") == [
        (1, ".k", "invalid type", "integer"), (2, "", "missing required field", "k"), (3, ".k", "invalid type", "integer"),
    ]


def test_many_rules_are_one_plan(spark):
    """The plan does not grow with the rules."""
    records = spark.range(3).select("id", F.parse_json(F.lit('{"m7":1}')).alias("record"))

    def size(n):
        found = [(None, f"m{i}", "string", False, None) for i in range(n)]
        df = rules.violation_rows(records, "record", table(spark, found), ["id"])
        assert df.count() == 3
        return len(df._jdf.queryExecution().analyzed().toString())

    assert abs(size(10) - size(400)) < 500


def test_problems_of_rules(spark):
    found = [
        ("f", "a.b", "string", False, None), ("f", "a", "list", False, None), ("f", "x..y", "string", False, None), ("f", "c", "text", False, None),
        ("f", "d", "string", False, None), ("f", "d", "integer", False, None), ("f", "e", "map", False, 2.0), ("f", "g[]", "string", False, 1.0),
    ]
    got = rows(rules.rule_problems(table(spark, found)), "feed", "path", "problem")
    assert got == [
        ("f", "a", "steps do not fit the type"), ("f", "c", "type"), ("f", "d", "more than one type"), ("f", "e", "min without size"), ("f", "x..y", "path"),
    ]


def test_odd_inputs(spark):
    """Empty rules, null and empty records, clashing column names."""
    df = spark.createDataFrame([(1, "p", '{"k":1}'), (2, None, None), (None, "r", "{}")], "id int, path string, text string")
    df = df.withColumn("record", F.try_parse_json("text")).withColumnsRenamed({"path": "value", "text": "found"})
    some = table(spark, [(None, "k", "string", True, None)])
    assert rows(rules.violation_rows(df, "record", some, ["id", "value", "found"]), "id", "value", "path", "detail") == [
        (1, "p", ".k", "integer"), (None, "r", "", "k"),
    ]
    assert rules.violation_rows(df, "record", some.limit(0), ["id"]).collect() == []
    assert rules.violation_rows(df.limit(0), "record", some, ["id"]).collect() == []
    least = spark.createDataFrame([("k", "integer")], "path string, type string")
    assert rules.violation_rows(df, "record", least, ["id"]).count() == 0


def test_values_do_not_carry_the_trie(spark):
    """Rows that a level makes have the number of the node above, not its edges and names."""
    records = spark.range(2).select("id", F.parse_json(F.lit('{"a":[{"b":1},{"c":2}]}')).alias("record"))
    found = rules.violation_rows(records, "record", table(spark, [(None, "a[].b", "string", True, None)]), ["id"])
    assert rows(found, "id", "path", "reason") == [
        (i, p, r) for i in range(2) for p, r in ((".a[0].b", "invalid type"), (".a[1]", "missing required field"), (".a[1]", "unknown field"))
    ]
    made = [line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Generate posexplode" in line]
    assert made and not [line for line in made if "edges" in line or "members" in line or "needed" in line]
