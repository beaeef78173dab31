"""Predicates over plain and variant attributes."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType

# Type tags of attribute values, by the JSON type of a variant.
TYPE_TAGS = {
    "string": "S",
    "number": "N",
    "boolean": "BOOL",
    "null": "NULL",
    "array": "L",
    "object": "M",
}


def size_of(value: Column, kind: DataType) -> Column:
    """Characters of a string, bytes of a binary, elements of a list or map."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.length(value)
    if isinstance(kind, (ArrayType, MapType)):
        return F.size(value)
    raise TypeError(f"{kind.simpleString()} has no size")


def begins_with(value: Column, prefix: str) -> Column:
    return value.startswith(prefix)


def contains(value: Column, operand, kind: DataType) -> Column:
    """Substring of a string or element of a list."""
    if isinstance(kind, ArrayType):
        return F.array_contains(value, operand)
    return F.contains(value, F.lit(operand))


def attribute_exists(item: Column, name: str) -> Column:
    """Is the key there, whatever its value. ``item`` is a variant object."""
    fields = F.try_variant_get(item, "$", "map<string,variant>")
    return F.coalesce(F.map_contains_key(fields, name), F.lit(False))


def attribute_not_exists(item: Column, name: str) -> Column:
    return ~attribute_exists(item, name)


def attribute_type(item: Column, name: str) -> Column:
    """Type tag of an attribute; null when the key is absent."""
    from viewloom.functions.nested import type_name

    value = F.try_variant_get(item, "$", "map<string,variant>")[name]
    kind = type_name(value)
    tag = F.element_at(F.create_map(*[F.lit(x) for pair in TYPE_TAGS.items() for x in pair]), kind)
    return F.when(attribute_exists(item, name), tag)


def all_of(*conditions: Column) -> Column:
    return reduce(and_, conditions)


def any_of(*conditions: Column) -> Column:
    return reduce(or_, conditions)
