"""Benchmark passages in documents, by a positional inverted index of the terms the passages pick.

For every window of a test item the rarest of its terms are looked up. Only those terms get posting
lists, so the index stays small however large the corpus is; each document's entry also keeps the
words around its postings. Lists are joined with the items' terms, shifted by the term's place in
the item and intersected; a window is reported only after its words were compared one by one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.arrays import Texts, free_names, owner, pieces, texts_of, with_short_batches, words_of
from viewloom.session import scratch_path

#: Words of test items that go to the workers at once; a larger test set is searched block by block.
BLOCK_WORDS = 2_000_000

#: Words: runs of letters, digits and everything beyond ASCII; A-Z count as a-z.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

INDEX = (
    "doc_key long, doc_id long, mark long, n_words long, postings array<struct<term: int, place: int>>, "
    "regions array<struct<start: int, words: string>>"
)


@dataclass
class Window:
    """``size`` words of an item from ``start``; ``rare`` are the places (in the item) of its rarest terms."""

    item: int
    start: int
    size: int
    rare: list[int]


def lowered(texts: Texts) -> Texts:
    return Texts(_LOWER[texts.data], texts.at)


def item_words(items: DataFrame) -> DataFrame:
    """Rows (item, item_id, words) of the test items that have words; null ids count as empty strings."""
    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))
    found = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words.alias("words"))
    return found.filter(F.size("words") > 0).distinct()


def _codes(words, terms: dict[bytes, int]) -> np.ndarray:
    """The term number of every word, -1 for words that are no terms."""
    numbers = np.fromiter((terms.get(w, -1) for w in words.vocabulary), np.int32, len(words.vocabulary))
    return numbers[words.codes]


def _lengths(handed):
    """Posting-list lengths: how often each term occurs in the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = handed.value
        totals = np.zeros(len(terms), np.int64)
        for piece in pieces(batches):
            words = words_of(lowered(texts_of(piece.column("text"))), _INSIDE)
            found = np.bincount(words.codes, minlength=len(words.vocabulary))
            for word, n in zip(words.vocabulary, found.tolist()):
                if word in terms:
                    totals[terms[word]] += n
        kept = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(kept.astype(np.int32)), pa.array(totals[kept])], names=["term", "n"])

    return count


def _postings(handed, reach: int):
    """One index row per document: its postings and the words up to ``reach`` around each."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        terms, key = handed.value, TaskContext.get().partitionId() << 40
        for piece in pieces(batches):
            words = words_of(lowered(texts_of(piece.column("text"))), _INSIDE)
            numbers = _codes(words, terms)
            places = np.flatnonzero(numbers >= 0)
            docs = owner(words.first)[places] if len(places) else places
            left = np.maximum(places - reach, words.first[docs])
            right = np.minimum(places + reach + 1, words.first[docs + 1])
            fresh = np.ones(len(places), bool)
            fresh[1:] = (docs[1:] != docs[:-1]) | (left[1:] > right[:-1])
            begins = np.flatnonzero(fresh)
            closes = right[np.append(begins[1:], len(places)) - 1] if len(begins) else begins
            near = [b" ".join([words.vocabulary[c] for c in words.codes[a:b].tolist()]).decode() for a, b in zip(left[begins].tolist(), closes.tolist())]
            n = piece.num_rows
            of_posting = np.searchsorted(docs, np.arange(n + 1)).astype(np.int32)
            of_region = np.searchsorted(docs[begins], np.arange(n + 1)).astype(np.int32)
            postings = pa.StructArray.from_arrays(
                [pa.array(numbers[places]), pa.array((places - words.first[docs]).astype(np.int32))], names=["term", "place"]
            )
            regions = pa.StructArray.from_arrays(
                [pa.array((left[begins] - words.first[docs[begins]]).astype(np.int32)), pa.array(near, pa.string())], names=["start", "words"]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(key + np.arange(n)), piece.column("doc_id").combine_chunks(), piece.column("mark").combine_chunks(), pa.array(np.diff(words.first).astype(np.int64)), pa.ListArray.from_arrays(of_posting, postings), pa.ListArray.from_arrays(of_region, regions)],
                names=["doc_key", "doc_id", "mark", "n_words", "postings", "regions"],
            )
            key += n

    return index


def choose(items: list[list[str]], terms: dict[str, int], lengths: dict[int, int], window: int, rarest: int) -> list[Window]:
    """Every window of every item with its rarest terms; windows with a term no document has are left out."""
    out = []
    for item, words in enumerate(items):
        size = min(window, len(words))
        counts = [lengths.get(terms[w], 0) for w in words]
        for start in range(len(words) - size + 1):
            places = sorted(range(start, start + size), key=lambda i: (counts[i], i))
            if counts[places[0]]:
                out.append(Window(item, start, size, sorted(places[:rarest])))
    return out


def build_index(docs: DataFrame, items: list[list[str]], window: int, rarest: int, folder: str) -> list[Window]:
    """Write the index of ``docs`` for these items below ``folder`` and return the windows to look up."""
    context = docs.sparkSession.sparkContext
    picked = with_short_batches(docs).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), F.col("text").cast("string"))
    numbers = {w: i for i, w in enumerate(sorted({w for words in items for w in words}))}
    handed = context.broadcast({w.encode(): i for w, i in numbers.items()})
    counted = picked.select("text").mapInArrow(_lengths(handed), "term int, n long").groupBy("term").agg(F.sum("n"))
    windows = choose(items, numbers, dict(counted.collect()), window, rarest)  # at most one row per term
    needed = {numbers[items[w.item][i]] for w in windows for i in w.rare}
    handed = context.broadcast({w.encode(): i for w, i in numbers.items() if i in needed})
    picked.mapInArrow(_postings(handed, window - 1), INDEX).write.mode("overwrite").parquet(folder)
    return windows


def lookup(index: DataFrame, items: list[list[str]], windows: list[Window], slack: int) -> DataFrame:
    """Rows (doc_key, item, start, size, exact): windows whose rare terms stand in a document at their
    distance, after comparing all words (``exact``), or at distances off by up to ``slack``."""
    spark = index.sparkSession
    numbers = {w: i for i, w in enumerate(sorted({w for words in items for w in words}))}
    places: dict[int, set[int]] = defaultdict(set)
    wanted: dict[int, list[tuple]] = defaultdict(list)
    for w in windows:
        places[w.item].update(w.rare)
        wanted[w.item].append((w.start, w.size, w.rare))
    terms = spark.createDataFrame(
        [(numbers[items[i][p]], i, p) for i, found in places.items() for p in found], "term int, item int, at int"
    )
    asked = spark.createDataFrame(
        [(i, items[i], found) for i, found in wanted.items()],
        "item int, item_words array<string>, windows array<struct<start: int, size: int, rare: array<int>>>",
    )
    lists = index.filter(F.size("postings") > 0).select("doc_key", F.explode("postings").alias("p")).select("doc_key", "p.*")
    # One row per document and item: its postings as (place in the item, shift). A document's postings bound it.
    shifted = lists.join(terms, "term").groupBy("doc_key", "item").agg(
        F.collect_set(F.struct("at", (F.col("place") - F.col("at")).alias("shift"))).alias("found")
    )
    joined = shifted.join(asked, "item")

    def shifts(place: Column) -> Column:
        return F.transform(F.filter("found", lambda x: x["at"] == place), lambda x: x["shift"])

    def candidates(w: Column) -> Column:
        first = shifts(w["rare"][0])
        # A shift counts if every other rare term has a posting within the slack of it.
        held = F.filter(first, lambda s: F.forall(w["rare"], lambda r: F.exists("found", lambda x: (x["at"] == r) & (F.abs(x["shift"] - s) <= slack))))
        return F.transform(held, lambda s: F.struct(w["start"].alias("from"), w["size"].alias("size"), (s + w["start"]).alias("start")))

    enough = F.exists("windows", lambda w: F.forall(w["rare"], lambda r: F.exists("found", lambda x: x["at"] == r)))
    hits = joined.filter(enough).select("doc_key", "item", "item_words", F.explode(F.flatten(F.transform("windows", candidates))).alias("hit"))
    # Compare the words: each document's regions meet its candidates, one row per document on either side.
    per_doc = hits.groupBy("doc_key").agg(F.collect_list(F.struct("item", "hit", F.slice("item_words", F.col("hit.from") + 1, F.col("hit.size")).alias("words"))).alias("hits"))
    regions = index.filter(F.size("regions") > 0).select("doc_key", F.transform("regions", lambda r: F.struct(r["start"].alias("start"), F.split(r["words"], " ").alias("words"))).alias("regions"))
    both = regions.join(per_doc, "doc_key").select("doc_key", "regions", F.explode("hits").alias("h"))
    start, size = F.col("h.hit.start"), F.col("h.hit.size")
    same = F.exists(
        "regions",
        lambda r: (r["start"] <= start)
        & (start + size <= r["start"] + F.size(r["words"]))
        & (F.slice(r["words"], F.greatest(start - r["start"], F.lit(0)) + 1, size) == F.col("h.words")),
    )
    return both.select("doc_key", F.col("h.item").alias("item"), start.alias("start"), size.alias("size"), same.alias("exact"))


def find_passages(docs: DataFrame, items: DataFrame, window: int = 10, rarest: int = 2, slack: int = 3) -> DataFrame:
    """Rows (doc_id, mark, n_words, n_hit, n_items, items_sha256, contaminated, n_near), one per document.

    ``mark`` is a hash of the text. A hit word lies in an occurrence of some window; ``n_near`` counts the items of which a window's
    rare terms stand up to ``slack`` words off their distance without an exact window. Null text has
    no words, items without words are ignored, equal item ids count once, null ids and repeated ids
    of documents stay rows of their own, and either table may be empty.
    """
    spark = docs.sparkSession
    tests = item_words(items)
    size = tests.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_WORDS))
    table, near = None, []
    for block in range(blocks):
        mine = tests if blocks == 1 else tests.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block)
        rows = mine.collect()  # at most about BLOCK_WORDS words
        folder = scratch_path(spark, "passages")
        words = [list(r["words"]) for r in rows]
        windows = build_index(docs, words, window, rarest, folder)
        index = spark.read.parquet(folder)
        table = index.select("doc_key", "doc_id", "mark", "n_words") if table is None else table
        if windows:
            names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id string")
            hit = lookup(index, words, windows, slack).join(names, "item").drop("item")
            # Row keys hold within one block's index only, so blocks are told together by id and text.
            near.append(hit if blocks == 1 else hit.join(index.select("doc_key", "doc_id", "mark"), "doc_key").drop("doc_key").distinct())
    if not near:
        hits = spark.createDataFrame([], "doc_key long, doc_id long, mark long, item_id string, start int, size int, exact boolean")
    else:
        hits = near[0]
        for more in near[1:]:
            hits = hits.unionByName(more)
    exact = F.when(F.col("exact"), F.col("item_id"))
    covered = F.when(F.col("exact"), F.sequence("start", F.col("start") + F.col("size") - 1))
    keys = ["doc_key"] if blocks == 1 else ["doc_id", "mark"]
    per_doc = hits.groupBy(*[F.col(k).alias(f"of_{k}") for k in keys]).agg(
        F.collect_set(exact).alias("items"),
        F.collect_set("item_id").alias("all_items"),
        F.size(F.array_distinct(F.flatten(F.collect_set(covered)))).cast("long").alias("n_hit"),
    )
    none = F.array().cast("array<string>")
    found = F.coalesce("items", none)
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
    return table.join(per_doc, same, "left").select(
        "doc_id",
        "mark",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(found), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.size(F.array_except(F.coalesce("all_items", none), found)).cast("long").alias("n_near"),
    )


def without_passages(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The documents in which no window of the test items occurs; all columns stay."""
    own_id, own_mark = free_names(docs, "id", "mark")
    found = find_passages(docs, items, **how).filter("contaminated").select(F.col("doc_id").alias(own_id), F.col("mark").alias(own_mark))
    same = docs["doc_id"].cast("long").eqNullSafe(found[own_id]) & (F.xxhash64(docs["text"].cast("string")) == found[own_mark])
    return docs.join(found, same, "left_anti")
