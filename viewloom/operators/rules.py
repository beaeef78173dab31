"""Validation of JSON records by rules that are rows of a table.

A rule says what stands at a path: its type, whether its holder must have it, and its least value (the
least length of a string or list). Paths are written ``a.b`` for members, ``a[]`` for the elements of a
list, ``a{}`` for the values of a map of any keys and ``a{key}`` for its keys; a name with other than
letters, digits, ``_`` and ``-`` stands in backticks. Rules of several feeds may share a table.

The rules become a trie, one row per path with numbered edges to the next steps. Records walk down it
level by level: each level is one join of the values below those reached so far with the trie, by node
and step, and one expression that is the same for all rules, so neither plan nor code grow with their
number; the values carry no more of the trie than the number of the node above. The trie is small
against the records and joined by whatever way Spark finds fit; records are never shuffled for a small
one. As many levels run as the longest path has steps, which one pass over the rules tells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.operators.quality import NO_JSON, VIOLATION, ListOf, MapOf, Scalar, Structure, found_if, kind_of_schema
from viewloom.session import scratch_path

RULES = "feed string, path string, type string, required boolean, min double"

# The types of a rule, and the JSON types each scalar takes. Booleans count as whole numbers.
HOLDERS = ("structure", "union", "list", "map")
TAKES = {
    "string": ("string",),
    "integer": ("integer", "boolean"),
    "double": ("integer", "fraction", "boolean"),
    "boolean": ("boolean",),
    "timestamp": ("string", "integer", "fraction"),
    "blob": ("string",),
}
TYPES = (*HOLDERS, *TAKES, "document")

_NAME = r"`(?:[^`]|``)+`|[A-Za-z0-9_-]+"
_STEP = rf"({_NAME}|\[\]|\{{\}}|\{{key\}})"
_PATH = rf"^(?:\.?(?:{_NAME}))?(?:\.(?:{_NAME})|\[\]|\{{\}}|\{{key\}})*$"

def _steps(path: Column) -> Column:
    """The steps of a path: ``[]``, ``{}``, ``{key}``, or a dot and the plain name."""
    return F.transform(
        F.regexp_extract_all(path, F.lit(_STEP), 1),
        lambda s: F.when(s.isin("[]", "{}", "{key}"), s).otherwise(
            F.concat(
                F.lit("."),
                F.when(F.startswith(s, F.lit("`")), F.replace(F.substring(s, F.lit(2), F.length(s) - 2), F.lit("``"), F.lit("`"))).otherwise(s),
            )
        ),
    )


def parsed(rules: DataFrame) -> DataFrame:
    """The rules with their ``steps``, null where a path cannot be read. A table without feeds, required
    marks or least values has none of them."""
    have = set(rules.columns)
    none = {"feed": "string", "required": "boolean", "min": "double"}
    rules = rules.withColumns({c: F.lit(None).cast(kind) for c, kind in none.items() if c not in have})
    path = F.coalesce("path", F.lit(""))
    return rules.select(
        F.coalesce("feed", F.lit("")).alias("feed"),
        path.alias("path"),
        F.col("type").cast("string").alias("type"),
        F.coalesce(F.col("required").cast("boolean"), F.lit(False)).alias("required"),
        F.col("min").cast("double").alias("min"),
        F.when(F.rlike(path, F.lit(_PATH)), _steps(path)).alias("steps"),
    )


def _holder(children: Column) -> Column:
    """What a node without a rule of its own must be, from its next steps."""
    return (
        F.when(F.array_contains(children, "[]"), "list")
        .when(F.arrays_overlap(children, F.array(F.lit("{}"), F.lit("{key}"))), "map")
        .when(F.size(children) > 0, "structure")
    )


def _prefixes(rules: DataFrame) -> DataFrame:
    """One row per path and each of its beginnings; only the path itself has the rule's values."""
    whole = F.size("steps")
    cut = rules.filter(F.col("steps").isNotNull()).select("*", F.explode(F.sequence(F.lit(0), whole)).alias("n"))
    own = F.col("n") == whole
    return cut.select(
        "feed",
        F.slice("steps", F.lit(1), F.col("n")).alias("node"),
        *[F.when(own, F.col(c)).alias(c) for c in ("type", "min")],
        (own & F.col("required")).alias("required"),
    )


def _nodes(rules: DataFrame) -> DataFrame:
    nodes = _prefixes(parsed(rules)).groupBy("feed", "node").agg(
        F.array_sort(F.collect_set("type")).alias("types"), F.max("min").alias("least"), F.bool_or("required").alias("required")
    )
    # Numbers in order of feed and path; the table of rules is small, a window over all of it is too.
    return nodes.withColumn("id", F.row_number().over(Window.orderBy("feed", "node")))


def trie(rules: DataFrame) -> DataFrame:
    """One row per node: feed, node (its steps), id, the id of its parent and the step from there (null
    for a root), type, least, edges (next step to id) and needed (names of required members). Several rules of one path combine: the largest least value, required if
    one says so, the type that sorts first. Rules whose path cannot be read are left out; see
    :func:`rule_problems`."""
    nodes = _nodes(rules)
    depth = F.size("node")
    below = nodes.filter(depth > 0).select(
        "feed", F.slice("node", F.lit(1), depth - 1).alias("node"), F.element_at("node", -1).alias("step"), F.col("id").alias("to"), "required"
    )
    name = F.expr("substring(step, 2)")
    edges = below.groupBy("feed", "node").agg(
        F.map_from_entries(F.collect_list(F.struct("step", "to"))).alias("edges"),
        F.array_sort(F.collect_set(F.when(F.col("required") & F.startswith("step", F.lit(".")), name))).alias("needed"),
    )
    above = below.join(nodes.select("feed", "node", F.col("id").alias("parent")), ["feed", "node"]).select(F.col("to").alias("id"), "parent", "step")
    joined = nodes.join(edges, ["feed", "node"], "left").join(above, "id", "left")
    steps = F.coalesce(F.map_keys("edges"), F.array().cast("array<string>"))
    return joined.select(
        "feed",
        "node",
        "id",
        "parent",
        "step",
        F.coalesce(F.get("types", F.lit(0)), _holder(steps), F.lit("document")).alias("type"),
        "least",
        F.coalesce("edges", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))).alias("edges"),
        F.coalesce("needed", F.array().cast("array<string>")).alias("needed"),
    )


def rule_problems(rules: DataFrame) -> DataFrame:
    """Rows (feed, path, problem): paths that cannot be read, unknown types, paths with more than one
    type, steps below a value that cannot have them, and least values of types that have no size."""
    read = parsed(rules)
    alone = F.array_compact(
        F.array(
            F.when(F.col("steps").isNull(), "path"),
            F.when(~F.coalesce(F.col("type").isin(*TYPES), F.lit(False)), "type"),
            F.when(F.col("min").isNotNull() & F.col("type").isin("structure", "union", "map", "document", "blob"), "min without size"),
        )
    )
    single = read.select("feed", "path", F.explode(alone).alias("problem"))
    nodes = trie(rules).join(_nodes(rules).select("feed", "node", "types"), ["feed", "node"])
    steps = F.map_keys("edges")
    fits = {
        "list": F.forall(steps, lambda s: s == "[]"),
        "map": F.forall(steps, lambda s: s.isin("{}", "{key}")),
        "structure": F.forall(steps, lambda s: F.startswith(s, F.lit("."))),
        "union": F.forall(steps, lambda s: F.startswith(s, F.lit("."))),
    }
    fit = F.size("edges") == 0
    for kind, test in fits.items():
        fit = F.when(F.col("type") == kind, test).otherwise(fit)
    shared = F.array_compact(F.array(F.when(F.size("types") > 1, "more than one type"), F.when(~fit, "steps do not fit the type")))
    path = F.regexp_replace(F.array_join("node", ""), r"^\.", "")
    return single.unionByName(nodes.select("feed", path.alias("path"), F.explode(shared).alias("problem"))).distinct()


def _none() -> Column:
    return F.array().cast(VIOLATION)


def _named(names: Column, reason: str) -> Column:
    """One violation of the value at ``path`` per name."""
    each = F.transform(names, lambda n: F.struct(F.col("path").alias("path"), F.lit(reason).alias("reason"), n.alias("detail")))
    return F.when(F.size(names) > 0, each).otherwise(_none())


def _found() -> Column:
    """The violations of a value, by the type that its node has. Plain expressions on columns, as they
    run for every value of every record."""
    path, type_, least, value, kind = (F.col(c) for c in ("path", "type", "least", "value", "kind"))
    takes = F.lit(False)
    for name, kinds in TAKES.items():
        takes = F.when(type_ == name, kind.isin(*kinds)).otherwise(takes)
    size = F.when(type_ == "string", F.length(F.try_variant_get(value, "$", "string")).cast("double")).otherwise(F.try_variant_get(value, "$", "double"))
    low = found_if(size < least, path, F.when(type_ == "string", "invalid length").otherwise("invalid range"), F.to_json(value))
    unreadable = (type_ == "timestamp") & (kind == "string") & F.try_to_timestamp(F.try_variant_get(value, "$", "string")).isNull()
    wrong = found_if(F.lit(True), path, "invalid type", kind)
    of_scalar = F.when(~takes, wrong).when(unreadable, F.concat(F.when(least.isNotNull(), low).otherwise(_none()), wrong)).when(least.isNotNull(), low).otherwise(_none())
    of_list = F.when(F.col("items").isNull(), wrong).otherwise(found_if(F.size("items") < least, path, "invalid length", F.size("items")))
    n = F.size("fields")
    of_union = F.concat(found_if(n == 0, path, "empty input"), found_if(n > 1, path, "more than one input"))
    # Every member of a structure is an edge, so as many fields as known ones leave none unknown.
    of_structure = F.concat(
        F.when(type_ == "union", of_union).otherwise(_none()),
        _named(F.array_except("needed", "names"), "missing required field"),
        _named(F.array_sort(F.array_except("names", "members")), "unknown field"),
    )
    types = F.regexp_replace(F.schema_of_variant(value), "`(?:[^`]|``)*+`|[A-Za-z_][A-Za-z0-9_]*: ", "")
    return (
        F.when(type_.isin(*TAKES), of_scalar)
        .when(type_ == "list", of_list)
        .when(type_ == "document", found_if(F.rlike(types, F.lit(NO_JSON)), path, "invalid type for document", types))
        .when(F.col("fields").isNull(), wrong)
        .when(type_ == "map", _none())
        .otherwise(of_structure)
    )


def _entries() -> Column:
    """The values one step down, as (key, value) in their order; the keys of a map follow as values."""
    type_ = F.col("type")
    none = F.array().cast("array<struct<key:string,value:variant>>")
    listed = F.arrays_zip(F.array_repeat(F.lit(None).cast("string"), F.size("items")).alias("key"), F.col("items").alias("value"))
    keys = F.transform("names", lambda k: F.struct(k.alias("key"), k.cast("variant").alias("value")))
    inside = F.map_entries("fields")
    return (
        F.when((type_ == "list") & F.col("items").isNotNull(), listed.cast("array<struct<key:string,value:variant>>"))
        .when(F.col("fields").isNotNull(), F.when(F.col("keyed"), F.concat(inside, keys)).otherwise(inside))
        .otherwise(none)
    )


#: What a value carries of its node while it is judged.
NODE = ("id", "type", "least", "needed", "members", "keyed")


def _judged(rows: DataFrame) -> DataFrame:
    """The values with their fields or items and with what is wrong with them. Rows that are done have no id
    and pass through."""
    value, type_ = F.col("value"), F.col("type")
    read = rows.withColumns(
        {
            "fields": F.when(type_.isin("structure", "union", "map"), F.try_variant_get(value, "$", "map<string,variant>")),
            "items": F.when(type_ == "list", F.try_variant_get(value, "$", "array<variant>")),
        }
    )
    plain = F.col("fields").isNull() & F.col("items").isNull() & type_.isNotNull()
    read = read.withColumns({"names": F.map_keys("fields"), "plain": plain})
    read = read.withColumn("schema", F.when(F.col("plain"), F.schema_of_variant(value)))
    read = read.withColumn("kind", F.when(F.col("plain"), kind_of_schema(F.col("schema"))))
    return read.withColumn("found", F.when(F.col("id").isNull(), F.col("found")).otherwise(_found()))


def _down(judged: DataFrame, steps: DataFrame, names: list[str]) -> DataFrame:
    """One step down: a row that has violations stays as it is, and every value below that has a node gets a
    row."""
    read = judged.withColumn("stays", F.coalesce((F.size("found") > 0).cast("int"), F.lit(0)))
    none = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value")))
    inside = F.when(F.col("id").isNull(), none).when(F.col("stays") == 1, F.concat(none, _entries())).otherwise(_entries())
    kept = [*names, "path", "id", "type", "found", "stays", F.size("fields").alias("n")]
    # The outer form keeps the optimizer from reading the values twice for a size check.
    below = read.select(*kept, F.posexplode_outer(inside).alias("at", "entry")).filter(F.col("at").isNotNull())
    own, at, key = F.col("at") < F.col("stays"), F.col("at") - F.col("stays"), F.col("entry.key")
    of_key = at >= F.col("n")
    step = (
        F.when(F.col("type") == "list", "[]")
        .when(F.col("type") == "map", F.when(of_key, "{key}").otherwise("{}"))
        .otherwise(F.concat(F.lit("."), key))
    )
    place = (
        F.when(F.col("type") == "list", F.concat(F.lit("["), at.cast("string"), F.lit("]")))
        .when((F.col("type") == "map") & of_key, F.concat(F.lit(" (key: "), key, F.lit(")")))
        .otherwise(F.concat(F.lit("."), key))
    )
    placed = below.select(
        *names,
        F.when(~own, F.concat("path", place)).alias("path"),
        F.when(~own, F.col("entry.value")).alias("value"),
        F.when(~own, F.col("id")).alias("parent"),
        F.when(~own, step).alias("step"),
        F.when(own, F.col("found")).alias("found"),
    )
    met = placed.join(steps, ["parent", "step"], "left")
    return met.filter(F.col("found").isNotNull() | F.col("id").isNotNull()).drop("parent", "step")


def violation_rows(records: DataFrame, record: str, rules: DataFrame, keep: list[str], feed: str | None = None) -> DataFrame:
    """Rows (keep..., path, reason, detail), one per violation: members that are missing, unknown or of
    the wrong type, values below the least, unions without exactly one member.

    ``record`` is a variant; ``feed`` names the column that says whose rules hold, and a record of a feed
    without rules has no violations. A value of the wrong type is not looked into. Null records have
    none. The columns kept may have any names but those of the result.
    """
    # Each level meets the trie, so it is written once.
    folder = scratch_path(records.sparkSession, "rule-trie")
    trie(rules).write.parquet(folder)
    nodes = records.sparkSession.read.parquet(folder)
    # One row: how deep the rules go.
    depth = nodes.agg(F.max(F.size("node"))).first()[0]
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    names = [f"k{i}" for i in range(len(keep))]
    members = F.transform(F.filter(F.map_keys("edges"), lambda k: F.startswith(k, F.lit("."))), lambda k: F.substring(k, F.lit(2), F.length(k)))
    known = nodes.withColumns({"members": members, "keyed": F.map_contains_key("edges", F.lit("{key}"))})
    roots = known.filter(F.size("node") == 0).select(F.col("feed").alias("of_feed"), *NODE)
    steps = known.filter(F.size("node") > 0).select("parent", "step", *NODE)
    whose = F.lit("") if feed is None else F.coalesce(F.col(f"`{feed}`").cast("string"), F.lit(""))
    rows = records.select(*kept, F.lit("").alias("path"), F.col(f"`{record}`").alias("value"), whose.alias("of_feed"))
    rows = rows.filter(F.col("value").isNotNull()).join(roots, "of_feed").drop("of_feed").withColumn("found", F.lit(None).cast(VIOLATION))
    rows = _judged(rows)
    for _ in range(depth or 0):
        rows = _judged(_down(rows, steps, names))
    found = rows.select(*names, F.explode_outer("found").alias("v")).filter(F.col("v").isNotNull())
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "v.path", "v.reason", "v.detail")


def _quoted(name: str) -> str:
    plain = name and all(c.isascii() and (c.isalnum() or c in "_-") for c in name)
    return name if plain else "`" + name.replace("`", "``") + "`"


def _number(least) -> float | None:
    return None if least is None else float(least)


def rules_of(shape, feed: str | None = None, path: str = "", required: bool = False) -> list[tuple]:
    """The rule rows that say the same as a shape of :mod:`viewloom.operators.quality`."""
    below = lambda step, s, must=False: rules_of(s, feed, path + step, must)
    if isinstance(shape, Scalar):
        return [(feed, path, shape.kind, required, _number(shape.min))]
    if isinstance(shape, ListOf):
        return [(feed, path, "list", required, _number(shape.min)), *below("[]", shape.member)]
    if isinstance(shape, MapOf):
        return [(feed, path, "map", required, None), *below("{}", shape.value), *below("{key}", shape.key)]
    if isinstance(shape, Structure):
        own = (feed, path, "union" if shape.union else "structure", required, None)
        members = [below(f".{_quoted(n)}", s, n in shape.required) for n, s in shape.members.items()]
        return [own, *[row for rows in members for row in rows]]
    return [(feed, path, "document", required, None)]
