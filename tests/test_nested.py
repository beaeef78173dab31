import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, VariantType

from viewloom.functions import nested, predicates


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame(
        [(1, [10, 20, 30, 40, 50]), (2, []), (3, None), (4, [7])], "id int, a array<int>"
    )


SLICES = [
    (None, None, 1), (1, 3, 1), (None, None, -1), (-2, None, 1), (None, -2, 1), (0, 100, 2),
    (4, 0, -2), (-1, -100, -1), (3, 1, 1), (10, 20, 1), (None, 2, -1), (-100, 2, 1),
]


@pytest.mark.parametrize("cut", SLICES, ids=str)
def test_slices_follow_python(lists, cut):
    got = {r.id: r.s for r in lists.select("id", nested.slice_steps(F.col("a"), *cut).alias("s")).collect()}
    for r in lists.collect():
        assert got[r.id] == (None if r.a is None else r.a[slice(*cut)])


def test_slice_step_zero():
    with pytest.raises(ValueError):
        nested.slice_steps(None, 0, 1, 0)


def test_elements(lists):
    got = lists.select("id", nested.element(F.col("a"), 0), nested.element(F.col("a"), -1), nested.element(F.col("a"), 9))
    assert rows(got) == [(1, 10, 50, None), (2, None, None, None), (3, None, None, None), (4, 7, 7, None)]


def test_numbers(lists):
    got = lists.select("id", nested.array_sum(F.col("a")), nested.array_avg(F.col("a")), F.array_max("a"))
    assert rows(got) == [(1, 150.0, 30.0, 50), (2, 0.0, None, None), (3, None, None, None), (4, 7.0, 7.0, 7)]


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def variant(text):
    return F.parse_json(F.lit(text))


def test_projection_drops_nulls(spark):
    a = F.expr("array(1, null, 3)")
    assert one(spark, nested.project(a, lambda x: x * 2)) == ([2, 6],)
    assert one(spark, nested.filter_project(a, lambda x: x > 1)) == ([3],)
    assert one(spark, nested.project_values(F.expr("map('a', 1, 'b', null)"))) == ([1],)


def test_flatten_once(spark):
    assert one(spark, nested.flatten_once(F.expr("array(array(1, 2), null, array(3))"))) == ([1, 2, None, 3],)
    mixed = F.try_variant_get(variant('[[1,[2]],"x",null,{"k":[3]}]'), "$", "array<variant>")
    flat = F.transform(nested.flatten_once_variant(mixed), lambda v: F.to_json(v))
    assert one(spark, flat) == (['1', '[2]', '"x"', "null", '{"k":[3]}'],)


@pytest.mark.parametrize(
    "text,expected",
    [('""', False), ("[]", False), ("{}", False), ("false", False), ("null", False), ("0", True), ('"0"', True), ("[0]", True)],
)
def test_variant_truth(spark, text, expected):
    assert one(spark, nested.truthy(variant(text), VariantType())) == (expected,)


def test_plain_truth(spark):
    s = StringType()
    assert one(spark, nested.truthy(F.lit(0.0), DoubleType()), nested.negate(F.lit(0.0), DoubleType())) == (True, False)
    assert one(spark, nested.either(F.lit(""), F.lit("b"), s), nested.both(F.lit("a"), F.lit("b"), s)) == ("b", "b")
    assert one(spark, nested.truthy(F.lit(None).cast("boolean"), BooleanType())) == (False,)


@pytest.mark.parametrize(
    "a,op,b,expected",
    [("1", "<", "2", True), ("1", "<", '"2"', None), ('"a"', "<", '"b"', True), ("true", "<", "2", None),
     ("[1]", "==", "[1]", True), ("1", "!=", '"1"', True), ("null", "==", "null", True), ("1", ">=", "null", None)],
)
def test_compare_variants(spark, a, op, b, expected):
    assert one(spark, nested.compare_variant(variant(a), op, variant(b))) == (expected,)


def test_order_is_stable_and_ties_go_to_the_first(spark):
    a = F.expr("array(struct('x' as n, 2 as k), struct('y' as n, 1 as k), struct('z' as n, 2 as k), struct('w' as n, 1 as k))")
    names = F.transform(nested.sort_by(a, lambda e: e["k"]), lambda e: e["n"])
    assert one(spark, names) == (["y", "w", "x", "z"],)
    assert one(spark, nested.max_by(a, lambda e: e["k"])["n"], nested.min_by(a, lambda e: e["k"])["n"]) == ("x", "y")


def test_merge_last_wins(spark):
    merged = nested.merge(F.expr("map('a', 1, 'b', 2)"), F.expr("map('b', 3)"), F.expr("map('c', 4, 'a', 5)"))
    assert one(spark, merged) == ({"a": 5, "b": 3, "c": 4},)


@pytest.mark.parametrize(
    "text,name,string,number",
    [('"7"', "string", "7", 7.0), ("7.5", "number", "7.5", 7.5), ("true", "boolean", "true", None),
     ("null", "null", "null", None), ('[1,"a"]', "array", '[1,"a"]', None), ('{"b":1}', "object", '{"b":1}', None),
     ('"x"', "string", "x", None)],
)
def test_casts(spark, text, name, string, number):
    v = variant(text)
    assert one(spark, nested.type_name(v), nested.as_string(v), nested.as_number(v)) == (name, string, number)


def test_flat_map(spark):
    got = lambda text: one(spark, F.transform(nested.flat_map(variant(text), "$.a"), lambda v: F.to_json(v)))[0]
    assert got('{"a":[1,null]}') == ["1", "null"]
    assert got('{"a":{"b":1}}') == ['{"b":1}']
    assert got('{"c":1}') == [None]
    assert got('{"a":[]}') == []


def test_multi_select_of_null(spark):
    null = F.lit(None).cast("string")
    assert one(spark, nested.select_list(null, F.lit(1)), nested.select_object(null, x=F.lit(1))) == (None, None)


def test_contains(spark):
    assert one(
        spark,
        nested.contains(F.lit("hello"), F.lit("ell"), StringType()),
        nested.contains(F.expr("array(1, null)"), F.lit(None).cast("int"), ArrayType(StringType())),
    ) == (True, True)


def test_attribute_predicates(spark):
    item = variant('{"s":"x","n":1,"b":true,"l":[],"m":{},"z":null}')
    tags = [predicates.attribute_type(item, k) for k in "snblmzq"]
    assert one(spark, *tags) == ("S", "N", "BOOL", "L", "M", "NULL", None)
    assert one(spark, predicates.attribute_exists(item, "z"), predicates.attribute_not_exists(item, "q")) == (True, True)
    with pytest.raises(TypeError):
        predicates.size_of(F.lit(1), DoubleType())
