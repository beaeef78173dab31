"""Queries inside nested values: paths, slices, projections and array functions.

All builders return row-local expressions. Absent and out-of-range values give
null, as in JSON path languages; nothing raises on missing data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    MapType,
    StringType,
    VariantType,
)

ElementFn = Callable[[Column], Column]


# --- access ---------------------------------------------------------------


def variant_path(value: Column, path: str, kind: str = "variant") -> Column:
    """Value at a ``$.a.b[0]`` path of a variant, null when absent or of another type."""
    return F.try_variant_get(value, path, kind)


def element(array: Column, index: int) -> Column:
    """Element by 0-based index; negative counts from the end."""
    return F.get(array, F.lit(index)) if index >= 0 else F.try_element_at(array, F.lit(index))


def slice_steps(
    array: Column, start: int | None = None, stop: int | None = None, step: int = 1
) -> Column:
    """Half-open slice with a step; a negative step walks backwards."""
    if step == 0:
        raise ValueError("slice step cannot be 0")
    size = F.size(array)
    lowest, highest = (F.lit(0), size) if step > 0 else (F.lit(-1), size - 1)

    def bound(position: int | None, default: Column) -> Column:
        if position is None:
            return default
        at = F.lit(position) if position >= 0 else size + F.lit(position)
        return F.least(F.greatest(at, lowest), highest)

    first = bound(start, lowest if step > 0 else highest)
    last = bound(stop, highest if step > 0 else lowest)
    if step == 1:
        return F.slice(array, first + 1, F.greatest(last - first, F.lit(0)))
    some = first < last if step > 0 else first > last
    inclusive = last - 1 if step > 0 else last + 1
    picked = F.transform(F.sequence(first, inclusive, F.lit(step)), lambda i: F.get(array, i))
    return F.when(array.isNotNull(), F.when(some, picked).otherwise(F.slice(array, 1, 0)))


# --- projections ----------------------------------------------------------


def project(array: Column, part: ElementFn) -> Column:
    """Apply to each element and drop the nulls."""
    return F.filter(F.transform(array, part), lambda x: x.isNotNull())


def project_values(mapping: Column, part: ElementFn = lambda x: x) -> Column:
    return project(F.map_values(mapping), part)


def filter_project(array: Column, keep: ElementFn, part: ElementFn = lambda x: x) -> Column:
    """Elements whose predicate holds (null is false), projected, without nulls."""
    return project(F.filter(array, lambda x: F.coalesce(keep(x), F.lit(False))), part)


def flatten_once(array: Column) -> Column:
    """One level of an array of arrays; a null element stays as a null."""
    return F.flatten(F.transform(array, lambda x: F.coalesce(x, F.array(F.lit(None)))))


def flatten_once_variant(array: Column) -> Column:
    """One level of an array of variants; elements that are no lists stay as they are."""
    return F.flatten(F.transform(array, as_list))


def select_list(base: Column, *parts: Column) -> Column:
    return F.when(base.isNotNull(), F.array(*parts))


def select_object(base: Column, **parts: Column) -> Column:
    return F.when(base.isNotNull(), F.struct(*[v.alias(k) for k, v in parts.items()]))


# --- truth ----------------------------------------------------------------


def truthy(value: Column, kind: DataType) -> Column:
    """False for null, ``''``, an empty list or object and ``false``; 0 is true."""
    if isinstance(kind, StringType):
        filled = value != ""
    elif isinstance(kind, (ArrayType, MapType)):
        filled = F.size(value) > 0
    elif isinstance(kind, BooleanType):
        filled = value
    elif isinstance(kind, VariantType):
        filled = ~F.to_json(value).isin("null", '""', "[]", "{}", "false")
    else:
        filled = value.isNotNull()
    return F.coalesce(filled, F.lit(False))


def either(left: Column, right: Column, kind: DataType) -> Column:
    return F.when(truthy(left, kind), left).otherwise(right)


def both(left: Column, right: Column, kind: DataType) -> Column:
    return F.when(truthy(left, kind), right).otherwise(left)


def negate(value: Column, kind: DataType) -> Column:
    return ~truthy(value, kind)


def compare_variant(left: Column, op: str, right: Column) -> Column:
    """Compare two variants. Equality is by value; order needs two numbers or two
    strings and is null for anything else."""
    if op in ("==", "!="):
        same = F.to_json(left).eqNullSafe(F.to_json(right))
        return same if op == "==" else ~same
    order = {"<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}[op]

    def when_both(name: str, cast: str) -> Column:
        a, b = (F.try_variant_get(v, "$", cast) for v in (left, right))
        return F.when((type_name(left) == name) & (type_name(right) == name), getattr(a, order)(b))

    return F.coalesce(when_both("number", "double"), when_both("string", "string"))


# --- numbers over arrays --------------------------------------------------


def array_sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda total, x: total + x.cast("double"))


def array_avg(array: Column) -> Column:
    return F.try_divide(array_sum(array), F.size(array))


# --- order ----------------------------------------------------------------


def sort_by(array: Column, key: ElementFn) -> Column:
    """Stable sort by a key of each element."""
    ranked = F.array_sort(F.transform(array, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"))))
    return F.transform(ranked, lambda r: F.get(array, r["i"]))


def _keyed(array: Column, key: ElementFn, sign: int) -> Column:
    ranked = F.transform(array, lambda x, i: F.struct(key(x).alias("k"), (i * sign).alias("i")))
    return F.filter(ranked, lambda r: r["k"].isNotNull())


def min_by(array: Column, key: ElementFn) -> Column:
    """Element with the smallest key; the first one on ties."""
    return F.get(array, F.array_min(_keyed(array, key, 1))["i"])


def max_by(array: Column, key: ElementFn) -> Column:
    """Element with the largest key; the first one on ties."""
    return F.get(array, -F.array_max(_keyed(array, key, -1))["i"])


# --- strings, objects, casts ----------------------------------------------


def length(value: Column, kind: DataType) -> Column:
    return F.length(value) if isinstance(kind, StringType) else F.size(value)


def contains(subject: Column, search: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return F.contains(subject, search)
    return F.exists(subject, lambda x: x.eqNullSafe(search))


def merge(*mappings: Column) -> Column:
    """Union of maps; on a shared key the last one wins."""
    def overlay(earlier: Column, later: Column) -> Column:
        kept = F.map_filter(earlier, lambda k, _: ~F.map_contains_key(later, k))
        return F.map_concat(kept, later)

    return reduce(overlay, mappings)


def type_name(variant: Column) -> Column:
    """boolean, array, object, null, string or number."""
    schema = F.schema_of_variant(variant)
    return (
        F.when(schema.isNull() | (schema == "VOID"), "null")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean")
        .otherwise("number")
    )


def as_list(variant: Column) -> Column:
    """A list as its elements, anything else as a list of one."""
    return F.coalesce(F.try_variant_get(variant, "$", "array<variant>"), F.array(variant))


def as_string(variant: Column) -> Column:
    """Strings stay; other values become compact JSON."""
    return F.when(type_name(variant) == "string", F.try_variant_get(variant, "$", "string")).otherwise(
        F.coalesce(F.to_json(variant), F.lit("null"))
    )


def as_number(variant: Column) -> Column:
    """Numbers stay, numeric strings are read, all else is null."""
    name = type_name(variant)
    text = F.trim(F.try_variant_get(variant, "$", "string"))
    return F.when(name == "number", F.try_variant_get(variant, "$", "double")).when(
        name == "string", text.try_cast("double")
    )


def flat_map(variant: Column, path: str) -> Column:
    """The rows a page gives at a path: list elements, or the value itself; a
    missing path gives one null."""
    found = F.try_variant_get(variant, path, "variant")
    return F.coalesce(
        F.try_variant_get(variant, path, "array<variant>"), F.array(found)
    )


def json_object(fields: Mapping[str, Column]) -> Column:
    """A JSON object text that keeps null fields."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})
