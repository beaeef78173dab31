"""Flatten nested tables: structs into columns, arrays into child tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def has_struct(df: DataFrame) -> bool:
    """True when a top-level column is a struct; arrays of structs do not count."""
    return any(isinstance(f.dataType, StructType) for f in df.schema.fields)


def _leaves(schema: StructType, path: tuple[str, ...] = ()):
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here, field.dataType


def _at(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{name}`" for name in path))


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every struct leaf as a column named by its path. Only the schema is read."""
    return df.select(*[_at(path).alias(sep.join(path)) for path, _ in _leaves(df.schema)])


def flatten_if_nested(df: DataFrame, sep: str = ".") -> DataFrame:
    return flatten_structs(df, sep) if has_struct(df) else df


def relationalize(
    df: DataFrame, key: list[str], root: str = "root", sep: str = "."
) -> dict[str, DataFrame]:
    """A set of flat tables: the root without arrays, and per array a child table
    with the root's key, the element's ``index`` and its flattened value.

    Arrays inside array elements become children of their child, keyed by the
    indexes on the way.
    """
    tables: dict[str, DataFrame] = {}

    def split(name: str, nested: DataFrame, keys: list[str]) -> None:
        flat = flatten_structs(nested, sep)
        arrays = [f.name for f in flat.schema.fields if isinstance(f.dataType, ArrayType)]
        tables[name] = flat.drop(*arrays)
        for column in arrays:
            position = "index" if "index" not in keys else f"index{len(keys)}"
            child = flat.select(
                *[F.col(f"`{k}`") for k in keys],
                F.posexplode(F.col(f"`{column}`")).alias(position, "value"),
            )
            split(f"{name}{sep}{column}", child, [*keys, position])

    split(root, df, key)
    return tables
