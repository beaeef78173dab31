"""Merging: result pages, last-write-wins upserts and sparse record patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.operators.ordered import join_same, running_sum
from viewloom.session import cut_lineage, scratch_path

# Pages of one request that one task orders at a time.
PAGES_PER_BLOCK = 1 << 16


def _block(page: str) -> Column:
    return F.floor(F.col(page) / PAGES_PER_BLOCK)


def merge_pages(
    pages: DataFrame, request: list[str], page: str, numbers: list[str], first: list[str]
) -> DataFrame:
    """One row per request: numbers summed over pages (nulls skipped), other keys
    from the first page."""
    return pages.groupBy(*request).agg(
        F.count(F.lit(1)).alias("pages"),
        *[F.sum(c).alias(c) for c in numbers],
        *[F.min_by(c, page).alias(c) for c in first],
    )


def _mark(payload: str) -> Column:
    """Tells pages with one number apart, and puts them in an order."""
    return F.xxhash64(payload).alias("_mark")


def _whole_mark(pages: DataFrame) -> Column:
    """Tells rows apart by all columns that have a hash."""
    return F.xxhash64(*[f.name for f in pages.schema if not any(k in f.dataType.simpleString() for k in ("map", "variant"))])


def _placed(slim: DataFrame, request: list[str], page: str) -> DataFrame:
    """(request, page, _mark, _size, _copies, _start): the place of the first of each kind of page; the
    copies of a page that comes several times follow each other."""
    kinds = slim.groupBy(*request, page, "_mark", "_size").agg(F.count(F.lit(1)).alias("_copies"))
    # Written, so that the payload is read for its marks once, and nothing of it reaches the ordering.
    folder = scratch_path(slim.sparkSession, "page-kinds")
    kinds.write.parquet(folder)
    kinds = slim.sparkSession.read.parquet(folder)
    ends = running_sum(kinds, request, [page, "_mark"], F.col("_size") * F.col("_copies"), "_end", _block(page))
    return ends.withColumn("_start", F.col("_end") - F.col("_size") * F.col("_copies")).drop("_end")


def _pieces(pages: DataFrame, request, page: str, payload: str, size: Column, cut, segment: int) -> DataFrame:
    """Cut each page's payload at segment borders of the whole request.

    Places are summed over rows of (request, page, size); the payload only meets
    its place and then its segment.
    """
    sized = pages.withColumns({"_size": F.coalesce(size, F.lit(0)).cast("bigint"), "_mark": F.xxhash64(payload)}).filter("_size > 0")
    places = _placed(sized.select(*request, page, "_mark", "_size"), request, page).drop("_size")
    keys = [*request, page, "_mark"]
    single = join_same(sized, places.filter("_copies = 1"), keys)
    # Copies are rare: one row stands for all of them until each has its place.
    several = join_same(sized, places.filter("_copies > 1"), keys).dropDuplicates(keys)
    copies = several.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    placed = single.unionByName(copies.withColumn("_start", F.col("_start") + F.col("_copy") * F.col("_size")).drop("_copy"))
    last = F.floor((F.col("_start") + F.col("_size") - 1) / segment)
    spans = placed.withColumn("segment", F.explode(F.sequence(F.floor(F.col("_start") / segment), last)))
    low = F.greatest(F.col("segment") * segment - F.col("_start"), F.lit(0)).cast("int")
    high = F.least((F.col("segment") + 1) * segment - F.col("_start"), F.col("_size")).cast("int")
    return spans.select(*request, "segment", F.col("_start"), cut(low, high - low).alias("_part"))


def merge_page_items(
    pages: DataFrame, request: list[str], page: str, items: str, segment: int = 10_000
) -> DataFrame:
    """The lists of all pages of a request as one list, in page order.

    The list comes in segments of ``segment`` items, numbered from 0, so a request
    of any length fits; a request shorter than that is one row with its whole list.
    """
    parts = _pieces(
        pages,
        request,
        page,
        items,
        F.size(items),
        lambda low, n: F.slice(items, low + 1, n),
        segment,
    )
    ordered = F.array_sort(F.collect_list(F.struct("_start", "_part")))
    return parts.groupBy(*request, "segment").agg(
        F.flatten(F.transform(ordered, lambda x: x["_part"])).alias(items)
    )


def merge_page_text(
    pages: DataFrame, request: list[str], page: str, text: str, segment: int = 1_000_000
) -> DataFrame:
    """The strings of all pages of a request joined, in segments of characters."""
    parts = _pieces(
        pages,
        request,
        page,
        text,
        F.length(text),
        lambda low, n: F.substring(F.col(text), low + 1, n),
        segment,
    )
    ordered = F.array_sort(F.collect_list(F.struct("_start", "_part")))
    return parts.groupBy(*request, "segment").agg(
        F.array_join(F.transform(ordered, lambda x: x["_part"]), "").alias(text)
    )


def _counted(pages: DataFrame, request: list[str], page: str, items: str, *others: str) -> DataFrame:
    """Rows (request, page, _mark, others, _size, _copies, _before) without the payload; ``_before`` counts
    the items before the first of the copies."""
    size = F.greatest(F.coalesce(F.size(items), F.lit(0)), F.lit(0)).cast("bigint").alias("_size")
    slim = pages.select(*request, page, _mark(items), size)
    placed = _placed(slim, request, page).withColumnRenamed("_start", "_before")
    if not others:
        return placed
    rest = pages.select(*request, page, _mark(items), *others).dropDuplicates([*request, page, "_mark"])
    return join_same(placed, rest, [*request, page, "_mark"])


def limit_pages(
    pages: DataFrame, request: list[str], page: str, items: str, max_items: int
) -> DataFrame:
    """Pages up to ``max_items`` items per request; the last one is cut to fit. Pages with one number
    follow each other in a fixed order.

    The last page of each request is found on slim rows; pages beyond it are
    dropped where they meet it.
    """
    if max_items < 1:
        raise ValueError("max_items must be at least 1")
    marked = pages.withColumn("_mark", _whole_mark(pages))
    size = F.greatest(F.coalesce(F.size(items), F.lit(0)), F.lit(0)).cast("bigint").alias("_size")
    counted = _placed(marked.select(*request, page, "_mark", size), request, page).filter(F.col("_start") < max_items)
    last = counted.groupBy(*request).agg(F.max(F.struct(page, "_mark", "_start", "_size", "_copies")).alias("_last"))
    here = F.struct(F.col(page).alias("p"), F.col("_mark").alias("m"))
    there = F.struct(F.col(f"_last.{page}").alias("p"), F.col("_last._mark").alias("m"))
    kept = join_same(marked, last, request)
    # One row stands for all copies of the last page until each has its place.
    end = kept.filter(here == there).dropDuplicates([*request, page, "_mark"])
    end = end.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_last._copies") - 1)))
    room = (max_items - F.col("_last._start") - F.col("_copy") * F.col("_last._size")).cast("int")
    # Null lists stay null, as they do on a page that is not cut.
    end = end.filter(room > 0).withColumn(items, F.slice(items, 1, room))
    return kept.filter(here < there).select(*pages.columns).unionByName(end.select(*pages.columns))


def resume_position(
    pages: DataFrame,
    request: list[str],
    page: str,
    items: str,
    max_items: int,
    skipped: str | None = None,
) -> DataFrame:
    """Where :func:`limit_pages` stopped: ``resume_page`` and ``resume_offset``.

    A cut page resumes inside itself (counting items already ``skipped`` there, and
    those of pages with its number before it), a full one at the next page.
    Requests that ended are absent.
    """
    counted = _counted(pages, request, page, items, *([skipped] if skipped else []))
    total = F.sum(F.col("_size") * F.col("_copies")).alias("_size")
    by_page = counted.groupBy(*request, page).agg(F.min("_before").alias("_before"), total, *([F.max(skipped).alias(skipped)] if skipped else []))
    end = F.col("_before") + F.col("_size")
    cut = (F.col("_before") < max_items) & (end > max_items)
    offset = max_items - F.col("_before") + (F.col(skipped) if skipped else F.lit(0))
    found = by_page.groupBy(*request).agg(
        F.max(F.when(cut, F.col(page))).alias("_cut_page"),
        F.max(F.when(cut, offset)).alias("_cut_offset"),
        F.min(F.when(F.col("_before") >= max_items, F.col(page))).alias("_next_page"),
    )
    return found.select(
        *request,
        F.coalesce("_cut_page", "_next_page").alias("resume_page"),
        F.coalesce("_cut_offset", F.lit(0)).cast("bigint").alias("resume_offset"),
    ).filter(F.col("resume_page").isNotNull())


def resume_pages(
    pages: DataFrame, positions: DataFrame, request: list[str], page: str, items: str
) -> DataFrame:
    """Pages from the resume position on; ``skipped`` counts items cut on the left."""
    joined = join_same(pages, positions, request).filter(F.col(page) >= F.col("resume_page"))
    skipped = F.when(F.col(page) == F.col("resume_page"), F.col("resume_offset")).otherwise(F.lit(0))
    left = F.greatest(F.size(items) - skipped, F.lit(0)).cast("int")
    return (
        joined.withColumn("skipped", skipped.cast("bigint"))
        .withColumn(items, F.slice(items, (F.col("skipped") + 1).cast("int"), left))
        .drop("resume_page", "resume_offset")
    )


def last_write(changes: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last change per key, puts and deletes alike."""
    rest = [c for c in changes.columns if c not in (*keys, seq)]
    return (
        changes.groupBy(*keys)
        .agg(F.max(seq).alias(seq), F.max_by(F.struct(*rest), seq).alias("_last"))
        .select(*keys, seq, "_last.*")
    )


def upsert_last_write(
    changes: DataFrame, keys: list[str], seq: str, op: str = "op", delete: str = "delete"
) -> DataFrame:
    """Table state after all changes: last write per key, deleted keys gone."""
    return last_write(changes, keys, seq).filter(F.col(op) != delete).drop(op)


# --- record patches -------------------------------------------------------


def _pointer_step(name: Column) -> Column:
    escaped = F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    return F.concat(F.lit("/"), escaped)


def _fields(variant: Column) -> Column:
    return F.map_entries(F.try_variant_get(variant, "$", "map<string,variant>"))


def _is_object(variant: Column) -> Column:
    return F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))


def _is_list(variant: Column) -> Column:
    return F.coalesce(F.schema_of_variant(variant).startswith("ARRAY"), F.lit(False))


def object_depth(patches: DataFrame, doc: str) -> int:
    """How deep objects nest in the documents. One pass, one number."""
    schema = F.regexp_replace(F.schema_of_variant(F.try_parse_json(doc)), "`(?:[^`]|``)*`", "f")
    brackets = F.regexp_extract_all(schema, F.lit("([<>])"), 1)
    state = F.aggregate(
        brackets,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda s, b: F.struct(
            (s["now"] + F.when(b == "<", 1).otherwise(-1)).alias("now"),
            F.greatest(s["most"], s["now"] + F.when(b == "<", 1).otherwise(-1)).alias("most"),
        ),
    )
    return patches.agg(F.max(state["most"])).first()[0] or 0


def patch_nodes(patches: DataFrame, key: list[str], seq: str, doc: str, depth: int) -> DataFrame:
    """One row per (record, path): JSON pointer, is it an object, JSON of the rest.

    Levels unfold inside the row, so the documents are read and parsed once.
    """

    def children(prefix: Column, value: Column) -> Column:
        return F.transform(
            _fields(value),
            lambda e: F.struct(
                F.concat(prefix, _pointer_step(e["key"])).alias("path"), e["value"].alias("value")
            ),
        )

    df = patches.withColumn("_doc", F.try_parse_json(doc)).withColumn(
        "_level0", children(F.lit(""), F.col("_doc"))
    )
    levels = ["_level0"]
    for number in range(1, depth):
        objects = F.filter(levels[-1], lambda n: _is_object(n["value"]))
        df = df.withColumn(
            f"_level{number}", F.flatten(F.transform(objects, lambda n: children(n["path"], n["value"])))
        )
        levels.append(f"_level{number}")
    # The outer form keeps the optimizer from unfolding the documents a second time
    # for a size check.
    nodes = df.select(*key, seq, F.explode_outer(F.concat(*levels)).alias("node")).filter(
        F.col("node").isNotNull()
    )
    value = F.col("node.value")
    return nodes.select(
        *key,
        seq,
        F.col("node.path").alias("path"),
        _is_object(value).alias("is_object"),
        F.when(~_is_object(value), F.to_json(value)).alias("value"),
    )


def broken_patches(patches: DataFrame, doc: str) -> DataFrame:
    """Patches that are no JSON objects, which the merges pass over."""
    return patches.filter(~_is_object(F.try_parse_json(doc)))


def fold_patches(patches: DataFrame, key: list[str], seq: str, doc: str) -> DataFrame:
    """Deep merge of sparse JSON objects per key, later ones win: (key, path, value).

    Objects merge, everything else (lists and explicit nulls too) replaces. A later
    scalar removes what was below its path, a later object replaces a scalar. An
    object left without members appears as ``{}``.
    """
    nodes = patch_nodes(patches, key, seq, doc, object_depth(patches, doc))
    scalar_seq = F.when(~F.col("is_object"), F.col(seq))
    # Read five times below with different columns, so it is written once: one row
    # per distinct path of a record.
    folded = cut_lineage(
        nodes.groupBy(*key, "path").agg(
            F.max(scalar_seq).alias("_scalar"),
            F.max(F.when(F.col("is_object"), F.col(seq))).alias("_object"),
            F.max_by("value", scalar_seq).alias("value"),
        )
    )
    steps = F.split("path", "/")
    above = F.transform(
        F.sequence(F.lit(2), F.size(steps) - 1),
        lambda n: F.array_join(F.slice(steps, 1, n), "/"),
    )
    above = F.when(F.size(steps) > 2, above)
    blockers = folded.filter(F.col("_scalar").isNotNull()).select(
        *key, F.col("path").alias("_above"), F.col("_scalar").alias("_block")
    )
    blocked = (
        folded.select(*key, "path", F.explode(above).alias("_above"))
        .join(blockers, [*key, "_above"])
        .groupBy(*key, "path")
        .agg(F.max("_block").alias("_block"))
    )
    judged = folded.join(blocked, [*key, "path"], "left")
    later = lambda one, other: F.col(other).isNull() | (F.col(one) > F.col(other))
    leaf = F.col("_scalar").isNotNull() & later("_scalar", "_object") & later("_scalar", "_block")
    branch = F.col("_object").isNotNull() & later("_object", "_scalar") & later("_object", "_block")
    alive = judged.withColumn("_leaf", leaf).withColumn("_branch", branch)
    leaves = alive.filter("_leaf").select(*key, "path", "value")
    parents = (
        alive.filter("_leaf OR _branch")
        .select(*key, F.regexp_replace("path", "/[^/]*$", "").alias("path"))
        .distinct()
    )
    empty = alive.filter("_branch").join(parents, [*key, "path"], "left_anti")
    return leaves.unionByName(empty.select(*key, "path", F.lit("{}").alias("value")))


def append_list_patches(patches: DataFrame, key: list[str], seq: str, doc: str) -> DataFrame:
    """Append mode for top-level lists: the elements of all patches in order.

    Rows (key, path, seq, pos, value); (seq, pos) is the order in the merged list.
    A value that is no list restarts it.
    """
    fields = patches.select(
        *key, seq, F.explode(_fields(F.try_parse_json(doc))).alias("field")
    ).select(*key, seq, _pointer_step(F.col("field.key")).alias("path"), F.col("field.value").alias("_v"))
    restarts = (
        fields.filter(~_is_list(F.col("_v")))
        .groupBy(*key, "path")
        .agg(F.max(seq).alias("_restart"))
    )
    elements = fields.filter(_is_list(F.col("_v"))).select(
        *key,
        seq,
        "path",
        F.posexplode(F.transform(F.try_variant_get("_v", "$", "array<variant>"), lambda v: F.to_json(v))).alias(
            "pos", "value"
        ),
    )
    joined = elements.join(restarts, [*key, "path"], "left")
    return joined.filter(F.col("_restart").isNull() | (F.col(seq) > F.col("_restart"))).drop("_restart")


def append_patches(patches: DataFrame, key: list[str], seq: str, doc: str) -> DataFrame:
    """Append mode for whole records: top-level lists grow, everything else merges.

    Rows (key, path, seq, pos, value). A top-level list that was written last comes
    element by element in the order of (seq, pos), from the first list after its
    last other value on; an empty one is a row ``[]`` without a position. All other
    paths are those of :func:`fold_patches`, without seq and pos.
    """
    fields = patches.select(*key, seq, F.explode(_fields(F.try_parse_json(doc))).alias("field")).select(
        *key, seq, _pointer_step(F.col("field.key")).alias("path"), _is_list(F.col("field.value")).alias("_list")
    )
    lists = fields.groupBy(*key, "path").agg(F.max_by("_list", seq).alias("_list")).filter("_list").drop("_list")
    elements = append_list_patches(patches, key, seq, doc).join(lists, [*key, "path"], "left_semi")
    empty = lists.join(elements.select(*key, "path").distinct(), [*key, "path"], "left_anti")
    kind = patches.schema[seq].dataType
    nothing = [F.lit(None).cast(kind).alias(seq), F.lit(None).cast("int").alias("pos")]
    order = [*key, "path", seq, "pos", "value"]
    others = fold_patches(patches, key, seq, doc).join(lists, [*key, "path"], "left_anti")
    return (
        elements.select(*order)
        .unionByName(empty.select(*key, "path", *nothing, F.lit("[]").alias("value")))
        .unionByName(others.select(*key, "path", *nothing, "value"))
    )
