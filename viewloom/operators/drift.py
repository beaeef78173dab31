"""Records whose fields change type between files.

The common schema of all records is one aggregate that merges: numbers widen, objects take the union of
their members, and a field whose types cannot be one stays a variant. Such a field becomes a *choice*: a
struct with one member per type seen, of which a row fills the one it has. A choice can also be cast to
one type, reduced to the values that have one type, or kept as JSON text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StructType, VariantType

from viewloom.operators.quality import scalar_kind

# The members of a choice, by the kind of value, with the type of each.
MEMBERS = {"integer": ("long", "bigint"), "fraction": ("double", "double"), "string": ("string", "string"), "boolean": ("boolean", "boolean"), "array": ("list", "variant"), "object": ("object", "variant")}


def common_schema(records: DataFrame, record: str) -> StructType:
    """The merged schema of all records, one row on the driver. Records that are no objects, and nulls,
    do not count; a table without objects has no fields."""
    objects = F.when(F.try_variant_get(F.col(record), "$", "map<string,variant>").isNotNull(), F.col(record))
    merged = records.agg(F.schema_of_variant_agg(objects)).first()[0]
    # A variant's schema is written like a struct's, under another name.
    parts = re.split(r"(`(?:[^`]|``)*`)", merged or "")
    ddl = "".join(p if i % 2 else re.sub(r"\bOBJECT<", "STRUCT<", p) for i, p in enumerate(parts))
    if not ddl.startswith("STRUCT<"):
        return StructType()
    return DataType.fromDDL(ddl)


def fields_of(schema: StructType, inside: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], DataType]]:
    """(path, type) of all fields, the members of structs after their struct."""
    for field in schema:
        yield (*inside, field.name), field.dataType
        if isinstance(field.dataType, StructType):
            yield from fields_of(field.dataType, (*inside, field.name))


def value_at(record: Column, path: tuple[str, ...]) -> Column:
    """The variant at a path of member names, whatever they look like."""
    for name in path:
        if "'" in name:
            record = F.try_element_at(F.try_variant_get(record, "$", "map<string,variant>"), F.lit(name))
        else:
            record = F.try_variant_get(record, f"$['{name}']", "variant")
    return record


def shown(path: tuple[str, ...]) -> str:
    return ".".join(path)


def type_counts(records: DataFrame, record: str, schema: StructType | None = None) -> DataFrame:
    """(path, kind, rows): how many records have which kind of value at each path of the common schema,
    JSON nulls included; a path that a record lacks does not count. Lists are not looked into."""
    schema = schema or common_schema(records, record)
    each = [F.struct(F.lit(shown(p)).alias("path"), value_at(F.col(record), p).alias("value")) for p, _ in fields_of(schema)]
    if not each:
        return records.sparkSession.createDataFrame([], "path string, kind string, rows long")
    values = records.select(F.inline(F.array(*each))).filter(F.col("value").isNotNull())
    return values.groupBy("path", scalar_kind(F.col("value")).alias("kind")).agg(F.count(F.lit(1)).alias("rows"))


def choices_of(records: DataFrame, record: str, schema: StructType) -> dict[str, list[str]]:
    """The kinds of value of each field that has no single type: a row per field and kind."""
    open_ = {shown(p) for p, t in fields_of(schema) if isinstance(t, VariantType)}
    if not open_:
        return {}
    found = type_counts(records, record, schema).filter(F.col("path").isin(*open_) & (F.col("kind") != "null"))
    kinds: dict[str, set[str]] = {p: set() for p in open_}
    for row in found.select("path", "kind").collect():
        kinds[row["path"]].add(row["kind"])
    return {p: [k for k in MEMBERS if k in kinds[p]] for p in sorted(open_)}


def _resolved(value: Column, kinds: list[str], how: str) -> Column:
    kind = scalar_kind(value)
    if how == "struct":
        members = []
        for k in kinds:
            name, type_ = MEMBERS[k]
            same = F.when(kind == k, value if type_ == "variant" else F.try_variant_get(value, "$", type_))
            members.append((F.to_json(same) if type_ == "variant" else same).alias(name))
        return F.struct(*members) if members else F.lit(None).cast("string")
    if how == "json":
        return F.to_json(value)
    action, _, type_ = how.partition(":")
    if action == "cast":
        return F.try_variant_get(value, "$", type_)
    if action == "project":
        takes = [k for k, (name, spark_type) in MEMBERS.items() if type_ in (name, spark_type)]
        return F.when(kind.isin(*takes), F.try_variant_get(value, "$", type_))
    raise ValueError(f"{how!r} is none of struct, json, cast:<type>, project:<type>")


def resolve(records: DataFrame, record: str, keep: list[str], how: dict[str, str] | str = "struct", schema: StructType | None = None) -> DataFrame:
    """The records as typed columns: ``keep``, then one column per field of the common schema.

    A field with a single type has that type, objects are structs, lists of one type are lists. A field
    whose types disagree is resolved as ``how`` says, for all or by path (``a.b``): ``struct`` makes a
    choice struct with the members ``long``, ``double``, ``string``, ``boolean``, ``list`` and ``object``
    that occur (the last two as JSON text), ``json`` the JSON text, ``cast:T`` the value as type T where it
    can be, and ``project:T`` only values that are of type T. Records that are no objects have null fields.
    """
    schema = schema or common_schema(records, record)
    kinds = choices_of(records, record, schema)

    def column(path: tuple[str, ...], type_: DataType) -> Column:
        value = value_at(F.col(record), path)
        if isinstance(type_, VariantType):
            chosen = how if isinstance(how, str) else how.get(shown(path), "struct")
            return _resolved(value, kinds[shown(path)], chosen)
        if isinstance(type_, StructType) and type_.fields:
            inner = F.struct(*[column((*path, f.name), f.dataType).alias(f.name) for f in type_])
            return F.when(F.try_variant_get(value, "$", "map<string,variant>").isNotNull(), inner)
        if isinstance(type_, NullType | StructType) or (isinstance(type_, ArrayType) and not _plain(type_)):
            return F.to_json(value)
        return F.try_variant_get(value, "$", type_.simpleString())

    return records.select(*keep, *[column((f.name,), f.dataType).alias(f.name) for f in schema])


def _plain(type_: DataType) -> bool:
    """Whether a list holds values of one type, at any depth."""
    if isinstance(type_, ArrayType):
        return _plain(type_.elementType)
    if isinstance(type_, StructType):
        return bool(type_.fields) and all(_plain(f.dataType) for f in type_)
    return not isinstance(type_, VariantType | NullType)
