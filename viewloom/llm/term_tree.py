"""Divergence between the sources of a language, by a frequent-pattern tree of term rows.

Every kept term has one row: the sources it occurs in, in their order, with its share in each. For two
sources a and b the distance is a sum over all kept terms, most of which neither has. So it is taken as
the distance of two absent terms for every term, plus a correction for terms that one of them has, plus
a second one for terms that both have. The first needs only a histogram per source. The second comes
from the tree: rows are inserted as paths, rows with a common beginning share its nodes, a node counts
the terms through it, and each pair of a node and one of its ancestors is corrected once for all of them.

Corrections add up, so a tree may be cut anywhere: paths are dealt by ranges, which keeps common
beginnings together, and each task builds trees of a bounded number of items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.arrays import owner, pieces, texts_of, with_short_batches, words_of
from viewloom.session import scratch_path

#: Documents of its language that a term must occur in, and terms reported per group.
LEAST_DOCS = 10
TOP = 10
#: Shares are whole numbers out of this, with two occurrences added to every term.
SCALE = 1_000_000_000
ADDED = 2
#: Text of one piece of the count, and path items of one tree.
PIECE = 12 << 20
ITEMS = 1 << 20

#: Bytes of a term: letters of ASCII and everything beyond it.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20

COUNTED = "lang string, source string, term string, n long, n_docs long"
CORRECTED = "lang string, a string, b string, both long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per language, source and term of each piece."""
    for piece in pieces(batches, limit=PIECE):
        texts = texts_of(piece.column("text"))
        texts.data = LOWERED[texts.data]
        words = words_of(texts, LETTERS)
        if not len(words.codes):
            continue
        size = len(words.vocabulary)
        in_doc, n = np.unique(owner(words.first) * size + words.codes, return_counts=True)
        doc, term = np.divmod(in_doc, size)
        group = pd.MultiIndex.from_arrays([piece.column("lang").to_pandas(), piece.column("source").to_pandas()])
        number, groups = group.factorize()
        key, at = np.unique(number[doc] * size + term, return_inverse=True)
        mine, term = np.divmod(key, size)
        # Sums below 2^53, which floats hold exactly.
        occurs = np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)
        langs, sources = (pa.array(groups.get_level_values(i), pa.string()) for i in (0, 1))
        vocabulary = pa.array(words.vocabulary, pa.binary()).cast(pa.string())
        found = [langs.take(pa.array(mine)), sources.take(pa.array(mine)), vocabulary.take(pa.array(term)), pa.array(occurs), pa.array(np.bincount(at, minlength=len(key)))]
        for batch in pa.table(found, names=["lang", "source", "term", "n", "n_docs"]).to_batches(max_chunksize=50_000):
            yield batch


def term_rows(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Rows (lang, term, n, row) of the terms in at least ``least_docs`` rows of their language; ``row``
    lists (source, n), in order of source."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    counted = with_short_batches(docs).select(*_names(), text).mapInArrow(_count, COUNTED)
    by_source = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    rows = by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("row")
    )
    return rows.filter(F.col("n_docs") >= least_docs).drop("n_docs")


def _names() -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def share(count: Column, total: Column, terms: Column) -> Column:
    """The share of a term in whole parts; null where no term is kept. Exact: 38 digits, then a whole division."""
    whole = lambda c: c.cast("decimal(28,0)")
    parts = F.lit(SCALE).cast("decimal(10,0)") * whole(count + ADDED)
    return F.when(terms > 0, 1 + F.call_function("div", parts, whole(total + ADDED * terms)))


def distance(p: Column, q: Column) -> Column:
    """How far two shares are apart, rounded down; below the larger of them."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


@dataclass
class Level:
    """The nodes of one depth: the node above, the source, its share, and the terms through the node."""

    above: np.ndarray
    source: np.ndarray
    share: np.ndarray
    terms: np.ndarray


def build(lengths: np.ndarray, source: np.ndarray, shares: np.ndarray, terms: np.ndarray) -> list[Level]:
    """The tree of paths: path i has ``lengths[i]`` items, stands for ``terms[i]`` terms, and items follow
    each other. Equal beginnings get the same nodes. All paths of a tree begin at one root."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    item, _ = pd.factorize(pd.MultiIndex.from_arrays([source, shares]))
    kinds = int(item.max(initial=0)) + 1
    node = np.zeros(len(lengths), np.int64)
    levels: list[Level] = []
    for depth in range(int(lengths.max(initial=0))):
        on = np.flatnonzero(lengths > depth)
        at = starts[on] + depth
        key, first, number = np.unique(node[on] * kinds + item[at], return_index=True, return_inverse=True)
        through = np.zeros(len(key), np.int64)
        np.add.at(through, number, terms[on])
        levels.append(Level(key // kinds, source[at[first]], shares[at[first]], through))
        node[on] = number
    return levels


def corrections(levels: list[Level], absent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over terms that two sources both have, as (ancestor's source, node's source, sum); what is
    summed is their distance beyond what the terms of each alone are corrected by. ``absent`` has each
    source's share of a term it lacks."""
    size = np.int64(len(absent))
    keys, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for depth, level in enumerate(levels):
        up = level.above
        for over in reversed(levels[:depth]):
            a, b = over.source[up], level.source
            p, q, p0, q0 = over.share[up], level.share, absent[a], absent[b]
            more = _distance(p, q) - _distance(p, q0) - _distance(p0, q) + _distance(p0, q0)
            key, number = np.unique(a * size + b, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, number, more * level.terms)
            keys.append(key)
            sums.append(total)
            up = over.above[up]
    key, number = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, number, np.concatenate(sums))
    return key // size, key % size, total


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of the trees of this task's paths; a tree has ``ITEMS`` items or one batch."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("path").flatten())
        if size >= ITEMS:
            yield _corrected(pa.Table.from_batches(held))
            held, size = [], 0
    if held:
        yield _corrected(pa.Table.from_batches(held))


def _corrected(paths: pa.Table) -> pa.RecordBatch:
    path = paths.column("path").combine_chunks()
    lengths = np.asarray(path.value_lengths(), np.int64)
    items = path.flatten()
    p, absent = (items.field(c).to_numpy(zero_copy_only=False) for c in ("p", "absent"))
    # A source is one per language, so a path's language is that of its first item.
    lang = paths.column("lang").to_pandas().to_numpy()[np.repeat(np.arange(len(lengths)), lengths)]
    source, names = pd.MultiIndex.from_arrays([lang, items.field("source").to_pandas()]).factorize()
    lacking = np.zeros(len(names), np.int64)
    lacking[source] = absent
    a, b, total = corrections(build(lengths, source, p, paths.column("terms").to_numpy()), lacking)
    langs, sources = (pa.array(names.get_level_values(i), pa.string()) for i in (0, 1))
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(a)), sources.take(pa.array(a)), sources.take(pa.array(b)), pa.array(total)], names=["lang", "a", "b", "both"]
    )


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and reread, as several parts of the audit start from it."""
    folder = scratch_path(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value): the distance of each two sources of a language."""
    paths = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "absent"))).alias("path"))
    paths = _kept(paths.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("terms")), "term-paths")
    dealt = with_short_batches(paths).repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    both = dealt.mapInArrow(_trees, CORRECTED).groupBy("lang", "a", "b").agg(F.sum("both").alias("both"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("lacked"))
    histogram = shares.groupBy("lang", "source", "p", "absent").agg(F.count(F.lit(1)).alias("terms"))
    alone = (
        histogram.join(other, "lang")
        .filter(F.col("source") != F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("terms") * (distance(F.col("p"), F.col("lacked")) - distance(F.col("absent"), F.col("lacked")))).alias("alone"))
    )
    back = alone.select("lang", F.col("source").alias("item"), F.col("item").alias("source"), F.col("alone").alias("back"))
    neither = F.col("terms") * distance(F.col("absent"), F.col("lacked"))
    parts = [neither, F.col("alone"), F.col("back"), F.col("both")]
    return (
        groups.join(other, "lang")
        .filter(F.col("source") != F.col("item"))
        .join(alone, ["lang", "source", "item"], "left")
        .join(back, ["lang", "source", "item"], "left")
        .withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")})
        .join(both, ["lang", "a", "b"], "left")
        .select("lang", "source", "item", sum((F.coalesce(x, F.lit(0)) for x in parts[1:]), F.coalesce(parts[0], F.lit(0))).alias("value"))
    )


def _ranked(values: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of every (lang, source) group that occurs.

    Part ``pair`` has the distance to each other source of the language; part ``term`` the ``top`` terms
    that the group has, and has more of than its language, by their distance. Ranks start at 1, largest
    value first, equal ones by the item's bytes. Null texts, languages and sources count as empty; every
    row is a document, equal ones too. A language without kept terms has distances of 0 and no terms; an
    empty table gives no rows. Columns other than text, lang and source are ignored.
    """
    rows = _kept(term_rows(docs, least_docs), "term-rows")
    totals = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    by_source = rows.select("lang", F.inline("row")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*_names()).distinct().join(totals, "lang", "left").join(by_source, ["lang", "source"], "left")
    groups = groups.fillna(0, ["terms", "lang_total", "total"])
    groups = _kept(groups.withColumn("absent", share(F.lit(0), F.col("total"), F.col("terms"))), "term-groups")
    shares = (
        rows.select("lang", "term", F.col("n").alias("lang_n"), F.inline("row"))
        .join(groups, ["lang", "source"])
        .withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    )
    typical = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    over = shares.withColumn("q", typical).filter(F.col("p") > F.col("q"))
    terms = over.select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    return _ranked(_pairs(shares, groups), "pair").unionByName(_ranked(terms, "term").filter(F.col("rank") <= top))
