"""Typed-attribute JSON ({"S": ...}, {"N": ...}, ...) to plain values and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DecimalType,
    FractionalType,
    IntegralType,
    MapType,
    StringType,
    StructType,
)

# Numbers keep 38 digits, exponents from -128 to 126.
DIGITS = 38
EXPONENTS = (-128, 126)


def attribute(item: Column, name: str, kind: str) -> Column:
    """One attribute of a tagged item as a plain column.

    ``kind`` is string, number (decimal(38,9), see :func:`number_text` for more),
    number_text, boolean, binary, string_set, number_set or is_null.
    """
    quote = "'" if '"' in name else '"'
    at = lambda tag, cast: F.try_variant_get(item, f"$[{quote}{name}{quote}].{tag}", cast)
    if kind == "string":
        return at("S", "string")
    if kind == "number_text":
        return number_text(at("N", "string"))
    if kind == "number":
        return at("N", "string").try_cast("decimal(38,9)")
    if kind == "boolean":
        return at("BOOL", "boolean")
    if kind == "binary":
        return F.try_to_binary(at("B", "string"), F.lit("base64"))
    if kind == "string_set":
        return F.array_distinct(at("SS", "array<string>"))
    if kind == "number_set":
        return F.array_distinct(F.transform(at("NS", "array<string>"), lambda n: n.try_cast("decimal(38,9)")))
    if kind == "is_null":
        return F.coalesce(at("NULL", "boolean"), F.lit(False))
    raise ValueError(f"unknown kind {kind!r}")


def number_text(text: Column) -> Column:
    """A decimal text if it fits the number type, else null. Too many digits or an
    exponent out of range would lose value, so they do not fit."""
    form = r"^[+-]?(\d+)(?:\.(\d*))?(?:[eE]([+-]?\d+))?$"
    whole = F.regexp_extract(text, form, 1)
    part = F.regexp_extract(text, form, 2)
    exponent = F.coalesce(F.nullif(F.regexp_extract(text, form, 3), F.lit("")).try_cast("int"), F.lit(0))
    digits = F.ltrim(F.regexp_replace(F.concat(whole, part), "0+$", ""), F.lit("0"))
    leading = F.length(F.regexp_replace(whole, "^0+", ""))
    first_zeros = F.length(F.regexp_extract(part, "^(0*)", 1))
    place = exponent + F.when(leading > 0, leading - 1).otherwise(-first_zeros - 1)
    fits = (F.length(digits) <= DIGITS) & ((digits == "") | place.between(*EXPONENTS))
    return F.when(text.rlike(form) & fits, text)


def untag(item: Column, depth: int) -> Column:
    """Plain JSON text of a tagged value nested at most ``depth`` levels.

    Sets become lists without repeats, binaries stay base64. A value without a
    known tag gives null, a value nested deeper is an error; :func:`untag_column`
    finds the depth by itself.
    """
    tags = F.try_variant_get(item, "$", "map<string,variant>")
    tag = F.get(F.map_keys(tags), F.lit(0))
    value = F.get(F.map_values(tags), F.lit(0))
    # "key" is null for list members.
    members = F.when(tag == "M", F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))).when(
        tag == "L",
        F.transform(
            F.try_variant_get(value, "$", "array<variant>"),
            lambda v: F.struct(F.lit(None).cast("string").alias("key"), v.alias("value")),
        ),
    )
    scalar = (
        F.when(tag == "NULL", F.lit("null"))
        .when(tag.isin("S", "B", "BOOL"), F.to_json(value))
        .when(tag == "N", number_text(F.try_variant_get(value, "$", "string")))
        .when(tag.isin("SS", "BS"), F.to_json(F.array_distinct(F.try_variant_get(value, "$", "array<string>"))))
        .when(
            tag == "NS",
            F.concat(
                F.lit("["),
                F.array_join(
                    F.array_distinct(F.transform(F.try_variant_get(value, "$", "array<string>"), number_text)), ","
                ),
                F.lit("]"),
            ),
        )
    )
    if depth == 0:
        deeper = F.raise_error(F.lit("a tagged value is nested deeper than the given depth"))
        return F.when(F.size(members) > 0, deeper.cast("string")).when(tag == "M", F.lit("{}")).when(tag == "L", F.lit("[]")).otherwise(scalar)
    inner = F.transform(
        members,
        lambda e: F.concat(
            F.when(e["key"].isNull(), F.lit("")).otherwise(F.concat(F.to_json(e["key"].cast("variant")), F.lit(":"))),
            F.coalesce(untag(e["value"], depth - 1), F.lit("null")),
        ),
    )
    body = F.array_join(inner, ",")
    return (
        F.when(tag == "M", F.concat(F.lit("{"), body, F.lit("}")))
        .when(tag == "L", F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(scalar)
    )


def untag_column(df: DataFrame, item: str, out: str) -> DataFrame:
    """Add the plain JSON of a column of tagged values, however deep. One pass finds the depth."""
    text = F.regexp_replace(F.to_json(F.col(item)), r'"(?:[^"\\]++|\\.)*+"', "")
    brackets = F.regexp_extract_all(text, F.lit(r"([\[{\]}])"), F.lit(1))
    nested = F.aggregate(
        brackets,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda s, b: F.struct(
            (s["now"] + F.when(b.isin("[", "{"), 1).otherwise(-1)).alias("now"),
            F.greatest(s["most"], s["now"] + F.when(b.isin("[", "{"), 1).otherwise(-1)).alias("most"),
        ),
        lambda s: s["most"],
    )
    deepest = df.agg(F.max(nested)).first()[0] or 0
    # A tagged value opens one bracket for its tag and one for its members.
    return df.withColumn(out, untag(F.col(item), -(-deepest // 2)))


def tag_value(value: Column, kind: DataType, as_set: bool = False) -> Column:
    """Tagged JSON text of a plain column. Floats are refused: they do not keep
    their decimal digits."""
    quoted = lambda v: F.to_json(v.cast("variant"))
    if isinstance(kind, BooleanType):
        tagged = F.concat(F.lit('{"BOOL":'), value.cast("string"), F.lit("}"))
    elif isinstance(kind, (IntegralType, DecimalType)):
        tagged = F.concat(F.lit('{"N":"'), value.cast("string"), F.lit('"}'))
    elif isinstance(kind, FractionalType):
        raise TypeError("float columns cannot be tagged, cast them to decimal first")
    elif isinstance(kind, StringType):
        tagged = F.concat(F.lit('{"S":'), quoted(value), F.lit("}"))
    elif isinstance(kind, BinaryType):
        tagged = F.concat(F.lit('{"B":"'), F.base64(value), F.lit('"}'))
    elif isinstance(kind, ArrayType) and as_set:
        member = kind.elementType
        tag = "SS" if isinstance(member, StringType) else "BS" if isinstance(member, BinaryType) else "NS"
        if isinstance(member, FractionalType) and not isinstance(member, DecimalType):
            raise TypeError("float columns cannot be tagged, cast them to decimal first")
        text = F.transform(F.array_distinct(value), lambda v: F.base64(v) if tag == "BS" else v.cast("string"))
        tagged = F.concat(F.lit(f'{{"{tag}":'), F.to_json(text), F.lit("}"))
    elif isinstance(kind, ArrayType):
        members = F.transform(value, lambda v: tag_value(v, kind.elementType))
        tagged = F.concat(F.lit('{"L":['), F.array_join(members, ","), F.lit("]}"))
    elif isinstance(kind, MapType):
        members = F.transform(
            F.map_entries(value),
            lambda e: F.concat(quoted(e["key"]), F.lit(":"), tag_value(e["value"], kind.valueType)),
        )
        tagged = F.concat(F.lit('{"M":{'), F.array_join(members, ","), F.lit("}}"))
    elif isinstance(kind, StructType):
        members = [
            F.concat(F.lit(f'"{f.name}":'), tag_value(value[f.name], f.dataType)) for f in kind.fields
        ]
        tagged = F.concat(F.lit('{"M":{'), F.concat_ws(",", *members), F.lit("}}"))
    else:
        raise TypeError(f"columns of type {kind.simpleString()} cannot be tagged")
    return F.when(value.isNull(), F.lit('{"NULL":true}')).otherwise(tagged)


def tag_rows(df: DataFrame, out: str = "item", sets: tuple[str, ...] = ()) -> DataFrame:
    """Each row as one tagged item."""
    members = [
        F.concat(F.lit(f'"{f.name}":'), tag_value(F.col(f"`{f.name}`"), f.dataType, f.name in sets))
        for f in df.schema.fields
    ]
    return df.withColumn(out, F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")))
