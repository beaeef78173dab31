"""Data quality: shape validation of JSON records and readiness checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.functions.binding import let

# The reasons below are texts that reports and their readers go by.
VIOLATION = "array<struct<path:string,reason:string,detail:string>>"


@dataclass(frozen=True)
class Scalar:
    """string, integer, double, boolean, timestamp or blob; ``min`` bounds the value,
    for a string its length."""

    kind: str
    min: float | None = None


@dataclass(frozen=True)
class ListOf:
    member: Scalar | ListOf | MapOf | Structure
    min: int | None = None


@dataclass(frozen=True)
class MapOf:
    value: Scalar | ListOf | MapOf | Structure
    key: Scalar = Scalar("string")


@dataclass(frozen=True)
class Structure:
    """An object with known members. A union holds exactly one member."""

    members: dict = field(default_factory=dict)
    required: tuple[str, ...] = ()
    union: bool = False


@dataclass(frozen=True)
class Document:
    """Free-form JSON of any shape; only values JSON has no type for are wrong."""


# JSON types a scalar kind takes. Booleans count as whole numbers.
_TAKES = {
    "string": ("string",),
    "integer": ("integer", "boolean"),
    "double": ("integer", "fraction", "boolean"),
    "boolean": ("boolean",),
    "timestamp": ("string", "integer", "fraction"),
    "blob": ("string",),
}


def kind_of_schema(schema: Column) -> Column:
    """The JSON type that a variant's schema stands for."""
    return (
        F.when(schema.isNull() | (schema == "VOID"), "null")
        .when(schema == "STRING", "string")
        .when(schema == "BIGINT", "integer")
        .when(F.rlike(schema, F.lit("^(DECIMAL|DOUBLE|FLOAT)")), "fraction")
        .when(schema == "BOOLEAN", "boolean")
        .when(F.startswith(schema, F.lit("ARRAY")), "array")
        .when(F.startswith(schema, F.lit("OBJECT")), "object")
        .otherwise(F.lower(schema))
    )


def scalar_kind(value: Column) -> Column:
    """The JSON type of a variant; the schema is read from the value once."""
    return let(F.schema_of_variant(value), kind_of_schema)


# Types a variant may hold that JSON text cannot.
NO_JSON = r"\b(DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|UUID|INTERVAL)\b"


def found_if(when: Column, path: Column, reason: Column | str, detail: Column | None = None) -> Column:
    """One violation if the condition holds, else none."""
    row = F.struct(
        path.alias("path"),
        (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"),
        (F.lit(None).cast("string") if detail is None else detail.cast("string")).alias("detail"),
    )
    return F.when(when, F.array(row)).otherwise(F.array().cast(VIOLATION))


def _each(values: Column, check) -> Column:
    return F.coalesce(F.flatten(F.transform(values, check)), F.array().cast(VIOLATION))


def _checker(shape, path: Column):
    return lambda value: violations(value, shape, path)


def violations(value: Column, shape, path: Column | None = None) -> Column:
    """All violations of a variant value, as an array: missing required members,
    unknown members, wrong types, values below the minimum, unions without exactly
    one member. A value of the wrong type is not looked into."""
    path = F.lit("") if path is None else path
    if isinstance(shape, Document):
        types = F.regexp_replace(F.schema_of_variant(value), "`(?:[^`]|``)*+`|[A-Za-z_][A-Za-z0-9_]*: ", "")
        return found_if(F.rlike(types, F.lit(NO_JSON)), path, "invalid type for document", types)
    if not isinstance(shape, Scalar):  # only named where the value is wrong, so not read from every record
        return _violations(value, scalar_kind(value), shape, path)
    return let(scalar_kind(value), lambda kind: _violations(value, kind, shape, path))


def _violations(value: Column, kind: Column, shape, path: Column) -> Column:
    if isinstance(shape, Scalar):
        wrong = ~kind.isin(*_TAKES[shape.kind])
        found = found_if(wrong, path, "invalid type", kind)
        if shape.min is not None:
            if shape.kind == "string":
                size, reason = F.length(F.try_variant_get(value, "$", "string")), "invalid length"
            else:
                size, reason = F.try_variant_get(value, "$", "double"), "invalid range"
            found = F.concat(found, found_if(~wrong & (size < shape.min), path, reason, F.to_json(value)))
        if shape.kind == "timestamp":
            unreadable = F.try_to_timestamp(F.try_variant_get(value, "$", "string")).isNull()
            found = F.concat(found, found_if((kind == "string") & unreadable, path, "invalid type", kind))
        return found

    if isinstance(shape, ListOf):
        items = F.try_variant_get(value, "$", "array<variant>")
        found = found_if(items.isNull(), path, "invalid type", kind)
        if shape.min is not None:
            found = F.concat(found, found_if(F.size(items) < shape.min, path, "invalid length", F.size(items)))
        inside = _each(
            items,
            lambda v, i: violations(v, shape.member, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))),
        )
        return F.concat(found, inside)

    fields = F.try_variant_get(value, "$", "map<string,variant>")
    wrong = found_if(fields.isNull(), path, "invalid type", kind)
    return F.concat(wrong, _each(F.array(fields), lambda f: _inside(f, shape, path)))


def _inside(fields: Column, shape, path: Column) -> Column:
    """Violations of the members of an object; none when it is null."""
    found = F.array().cast(VIOLATION)
    if isinstance(shape, MapOf):
        entries = F.map_entries(fields)
        keys = _each(
            entries,
            lambda e: violations(
                e["key"].cast("variant"), shape.key, F.concat(path, F.lit(" (key: "), e["key"], F.lit(")"))
            ),
        )
        values = _each(entries, lambda e: violations(e["value"], shape.value, F.concat(path, F.lit("."), e["key"])))
        return F.concat(found, keys, values)

    if shape.union:
        found = F.concat(
            found,
            found_if(F.size(fields) == 0, path, "empty input"),
            found_if(F.size(fields) > 1, path, "more than one input"),
        )
    for name in shape.required:
        missing = fields.isNotNull() & ~F.map_contains_key(fields, name)
        found = F.concat(found, found_if(missing, path, "missing required field", F.lit(name)))
    known = F.array(*[F.lit(n) for n in shape.members]).cast("array<string>")
    unknown = F.array_sort(F.array_except(F.map_keys(fields), known))
    found = F.concat(
        found, _each(unknown, lambda n: found_if(F.lit(True), path, "unknown field", n))
    )
    for name, member in shape.members.items():
        here = F.concat(path, F.lit(f".{name}"))
        present = F.when(F.map_contains_key(fields, name), F.array(fields[name]))
        # As a lambda's argument the member is read once, however deep the shape is.
        found = F.concat(found, _each(present, _checker(member, here)))
    return found


def violation_rows(df: DataFrame, record: str, shape, keep: list[str]) -> DataFrame:
    """One row per violation."""
    found = violations(F.col(record), shape)
    # The outer form keeps the optimizer from validating twice for a size check.
    rows = df.select(*keep, F.explode_outer(found).alias("v")).filter(F.col("v").isNotNull())
    return rows.select(*keep, "v.path", "v.reason", "v.detail")


def violation_report(rows: DataFrame) -> DataFrame:
    """How often each rule is broken; list positions are folded together."""
    place = F.regexp_replace("path", r"\[\d+\]", "[]")
    return rows.groupBy(place.alias("path"), "reason").agg(F.count(F.lit(1)).alias("violations"))


# --- readiness ------------------------------------------------------------


def path_all(values: Column, expected) -> Column:
    """Every element equals the expected value; an empty or missing list fails."""
    want = expected if isinstance(expected, Column) else F.lit(expected)
    return F.coalesce((F.size(values) > 0) & F.forall(values, lambda v: v.eqNullSafe(want)), F.lit(False))


def path_any(values: Column, expected) -> Column:
    """Some element equals the expected value."""
    want = expected if isinstance(expected, Column) else F.lit(expected)
    return F.coalesce(F.exists(values, lambda v: v.eqNullSafe(want)), F.lit(False))


def path_equals(value: Column, expected) -> Column:
    return value.eqNullSafe(expected if isinstance(expected, Column) else F.lit(expected))


def readiness(rows: DataFrame, key: list[str], value: str, expected) -> DataFrame:
    """The same checks over the rows of each group, without collecting the group."""
    same = path_equals(F.col(value), expected)
    return rows.groupBy(*key).agg(
        F.bool_and(same).alias("all_equal"), F.bool_or(same).alias("any_equal")
    )
