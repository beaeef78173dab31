"""Near-duplicate classes by Order MinHash and banded alignment.

A text is a row of k-mers of five words, each labelled with its occurrence number. A sketch takes the
few k-mers with the smallest hashes and keeps them in text order, so texts agree on a sketch if they
share those k-mers in that order, which follows edit similarity rather than bags of words. Texts that
agree on a sketch are candidates. Their words are aligned in a band whose width the threshold gives; the
similarity is aligned / (n + m - aligned), the ordered form of Jaccard's. At 0.8 one word in nine may
have been exchanged, wherever it stands.

Copies are one node. In a bucket every node is compared with the bucket's first node. In buckets where
nodes of different classes stay, further pairs are made unless exact bounds say that their k-mer rows,
aligned in the same way, cannot be as similar; so similar texts that are both unlike the first are found
too, and no task or row ever holds a whole bucket.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.arrays import SPACES, Texts, free_names, mix, owner, pieces, texts_of, with_short_batches, words_of
from viewloom.session import scratch_path

KMER = 5
SIMILAR = 0.8
#: Sketches of a text and k-mers of a sketch. Texts of similarity 0.8 miss all sketches with probability 1e-6.
SKETCHES = 20
PICKED = 3
SEED = 0x5EED
#: Hash bins of the histograms that bound how many k-mers two texts share.
BINS = 256
#: Ids from here on are the documents' own; nodes below stand for null ids.
NAMED = -(1 << 61)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def word_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, lower-cased in ASCII, and where each text's begin."""
    words = words_of(Texts(_LOWER[texts.data], texts.at), ~SPACES)
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.vocabulary), np.uint64, len(words.vocabulary))
    return distinct[words.codes] if len(distinct) else np.zeros(0, np.uint64), words.first


def kmer_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-mers of all texts, and where each text's begin; a shorter text is one k-mer."""
    values, of_text = word_hashes(texts)
    n = np.diff(of_text)
    counts = np.where(n >= KMER, n - KMER + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(counts)])
    places = np.arange(first[-1]) + np.repeat(of_text[:-1] - first[:-1], counts)
    size = np.repeat(np.minimum(n, KMER), counts)
    out = np.zeros(len(places), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(KMER):
            have = size > j
            step = out * np.uint64(0x9E3779B97F4A7C15) + values[np.minimum(places + j, max(len(values) - 1, 0))]
            out = np.where(have, step, out)
    return mix(out), first


def labelled(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """K-mer hashes with the occurrence number within their text mixed in."""
    with np.errstate(over="ignore"):
        keys = mix(hashes + owner(first).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[1:] = keys[order][1:] == keys[order][:-1]
    index = np.arange(len(keys))
    begin = np.maximum.accumulate(np.where(same, 0, index)) if len(keys) else index
    out = hashes.copy()
    again = np.flatnonzero(same)
    with np.errstate(over="ignore"):
        out[order[again]] += (again - begin[again]).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    return out


def sketches(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SKETCHES hashes per text: of its PICKED smallest labelled k-mers, in text order."""
    n = np.diff(first)
    text = owner(first)
    out = np.zeros((len(n), SKETCHES), np.uint64)
    # Only hashes below a share of the range that leaves a dozen are sorted; a text left with too few is sorted whole.
    full = np.iinfo(np.uint64).max
    bound = np.where(n > 16, np.minimum(12.0 / np.maximum(n, 1), 1.0) * float(full), float(full) * 0.999999)
    bound = np.where(n > 16, bound.astype(np.uint64), full)
    limit = np.repeat(bound, n)
    rng = np.random.default_rng(SEED)
    with np.errstate(over="ignore"):
        for s in range(SKETCHES):
            add, odd = rng.integers(0, full, 2, np.uint64, endpoint=True)
            values = (labels + add) * (odd | np.uint64(1))
            values ^= values >> np.uint64(32)
            values *= np.uint64(0xE7037ED1A0B428DB)
            near = np.flatnonzero(values <= limit)
            have = np.bincount(text[near], minlength=len(n))
            few = np.flatnonzero(have < np.minimum(n, PICKED))
            if len(few):
                near = np.union1d(near, np.concatenate([np.arange(first[i], first[i + 1]) for i in few]))
                have = np.bincount(text[near], minlength=len(n))
            order = near[np.lexsort((values[near], text[near]))]
            rank = np.arange(len(order)) - np.repeat(np.cumsum(have) - have, have)
            chosen = np.sort(order[rank < PICKED])
            hashed = np.zeros(len(n), np.uint64)
            count = np.bincount(text[chosen], minlength=len(n))
            begin = np.cumsum(count) - count
            for k in range(PICKED):
                has = count > k
                hashed[has] = mix(hashed[has] * np.uint64(0x9E3779B97F4A7C15) + labels[chosen[begin[has] + k]] + np.uint64(s + 1))
            out[:, s] = hashed
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        hashes, first = kmer_hashes(texts_of(piece.column("text")))
        values = sketches(labelled(hashes, first), first).view(np.int64)
        n = np.diff(first)
        at = np.concatenate([[0], np.cumsum(np.where(n > 0, SKETCHES, 0))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [piece.column("key").combine_chunks(), piece.column("node").combine_chunks(), pa.ListArray.from_arrays(at, pa.array(values[n > 0].ravel())), pa.array(n)],
            names=["key", "node", "sketch", "n_kmers"],
        )


def aligned(left: list[int], right: list[int], band: int) -> int:
    """Length of the longest common subsequence that stays within ``band`` of the diagonal.

    Row by row with one bit per column of the band: a column whose bit is cleared adds one to the
    length. Columns that leave the band keep what they have.
    """
    places: dict[int, list[int]] = {}
    for j, value in enumerate(right):
        places.setdefault(value, []).append(j)
    total, low, bits, width = 0, 0, 0, 0  # ``bits`` covers columns low .. low + width - 1
    for i, value in enumerate(left):
        start, stop = max(0, i - band), min(len(right), i + band + 1)
        if stop <= start:
            break
        if start > low:
            gone = min(start - low, width)
            total += gone - (bits & ((1 << gone) - 1)).bit_count()
            bits >>= gone
            width -= gone
            low = start
        if stop > low + width:
            bits |= ((1 << (stop - low - width)) - 1) << width
            width = stop - low
        match = 0
        found = places.get(value, ())
        for at in range(bisect_left(found, start), len(found)):
            if found[at] >= stop:
                break
            match |= 1 << (found[at] - low)
        if match:
            used = bits & match
            bits = ((bits + used) | (bits & ~match)) & ((1 << width) - 1)
    return total + width - bits.bit_count()


def similarity(left: list[int], right: list[int], least: float = SIMILAR) -> float:
    """aligned / (n + m - aligned), or 0.0 if it is below ``least``. Exact at or above ``least``.

    The band starts narrow and doubles up to the width beyond which no alignment can reach ``least``.
    """
    n, m = len(left), len(right)
    if not n or not m:
        return 0.0
    needed = ceil(least * (n + m) / (1 + least) - 1e-9)
    counts = Counter(left)
    counts.subtract(Counter(right))
    if (n + m - sum(map(abs, counts.values()))) / 2 < needed:  # even unordered they share too few
        return 0.0
    widest = n + m - 2 * needed + 1
    band = 32
    while True:
        common = aligned(left, right, min(band, widest))
        if common >= needed or band >= widest:
            value = common / (n + m - common)
            return value if value >= least - 1e-12 else 0.0
        band *= 4


def _verify(least: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text="b_text"):
            (left, of_left), (right, of_right) = (word_hashes(texts_of(piece.column(c))) for c in ("a_text", "b_text"))
            good = np.zeros(piece.num_rows, bool)
            for i in range(piece.num_rows):
                one = left[of_left[i] : of_left[i + 1]].tolist()
                good[i] = similarity(one, right[of_right[i] : of_right[i + 1]].tolist(), least) > 0
            yield from piece.select(["a", "b"]).filter(pa.array(good)).combine_chunks().to_batches()

    return verify


def _kmers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, class, kmer, n): how often each k-mer occurs in each text."""
    for piece in pieces(batches):
        hashes, first = kmer_hashes(texts_of(piece.column("text")))
        text = owner(first)
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(fresh)
        n = np.diff(np.append(begin, len(hashes)))
        whose = pa.array(text[begin])
        yield pa.RecordBatch.from_arrays(
            [piece.column("node").combine_chunks().take(whose), piece.column("class").combine_chunks().take(whose), pa.array(hashes[begin].view(np.int64)), pa.array(n)],
            names=["node", "class", "kmer", "n"],
        )


def _saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, which ends the lineage."""
    folder = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def components(links: DataFrame) -> DataFrame:
    """Rows (node, class) for links (a, b): class is the smallest node that can be reached.

    Large-star and small-star steps by turns: neighbours are tied to the smallest of them, until every
    node has one link and all links end in nodes that have none. A hot node's links are aggregated or
    joined, never collected.
    """
    links = _saved(links.select("a", "b").filter("a != b").distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        # Large star: larger neighbours are tied to the smallest.
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()
        # Small star: smaller neighbours and the node itself are tied to the smallest.
        smallest = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(smallest, "a")
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(smallest.select("a", F.col("least").alias("b")))
        links = _saved(small.filter("a != b").distinct(), "links")
        # A node that is linked on, or linked twice, shows up more than once here.
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("n")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("n")).distinct())
        if ends.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("links")).filter("links > 0 AND rows > 1").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("class"))


def _first_of(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's first node, the one that shares most buckets with others, and the rest."""
    order = F.struct((-F.col("score")).alias("s"), "node")
    firsts = members.groupBy("bucket").agg(F.min(order)["node"].alias("first"))
    pairs = members.join(firsts, "bucket").filter("node != first")
    return pairs.select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()


def _key_and_node() -> tuple[Column, Column]:
    """A key that equal texts share, and the id; null ids get one from the text, below all others."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    unnamed = F.lit(NAMED) - 1 - F.pmod(F.xxhash64(F.md5(text)), F.lit(1 << 61))
    return F.md5(text), F.coalesce(F.col("doc_id").cast("long"), unnamed)


def classes_of(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """Rows (node, key, class), one per document; see ``near_duplicates``."""
    key, node = _key_and_node()
    base = with_short_batches(docs).select(node.alias("node"), key.alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sketched = base.select("key", "node", "text").mapInArrow(_sketch, "key string, node long, sketch array<long>, n_kmers long")
    nodes = sketched.groupBy("key").agg(F.min("node").alias("node"), F.first("sketch").alias("sketch"), F.first("n_kmers").alias("n_kmers"))
    nodes = _saved(nodes, "nodes")

    rows = nodes.select("node", F.explode("sketch").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = rows.join(sizes, "bucket")
    scores = shared.groupBy("node").agg(F.sum("size").alias("score"))
    members = _saved(shared.select("bucket", "node").join(scores, "node"), "members")

    # Always by a shuffle: the nodes in buckets grow with the documents, so they are never broadcast.
    involved = members.select("node").distinct().hint("merge")
    texts = base.select("node", "text").join(involved, "node").distinct()
    texts = _saved(texts, "texts")

    def linked(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
        return _saved(pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text").mapInArrow(_verify(least), "a long, b long"), "verified")

    classes = components(linked(_first_of(members)))
    own = members.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    mixed = own.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    undecided = _saved(own.join(mixed.select("bucket"), "bucket"), "undecided")
    more = linked(_rest(undecided, nodes, texts, least))
    classes = components(classes.select(F.col("node").alias("a"), F.col("class").alias("b")).unionByName(more))

    named = base.select("node", "key").join(nodes.select("key", F.col("node").alias("first")), "key")
    found = named.join(classes.withColumnRenamed("node", "first"), "first", "left")
    return found.select("node", "key", F.coalesce("class", "first").alias("class"))


def near_duplicates(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """Rows (doc_id, class), one per document; a class is named by its smallest doc_id.

    Documents are linked if their words have similarity ``least`` or more, and classes are what links
    connect. Equal texts are always one class, also texts without words (null counts as empty),
    which are like nothing else. Rows with equal doc_id count as one document; a null doc_id is a
    document of its own per text, and null names a class of such documents only if no other is in it.
    An empty table gives no rows; other columns are ignored.
    """
    found = classes_of(docs, least)
    # Unnamed nodes are smaller than all others, so a class that has both takes its name from the others.
    names = found.groupBy("class").agg(F.min(F.when(F.col("node") >= NAMED, F.col("node"))).alias("name"))
    named = F.when(F.col("node") >= NAMED, F.col("node"))
    return found.join(names, "class").select(named.alias("doc_id"), F.col("name").alias("class"))


def keep_first(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The documents with one of each class kept, the one with the smallest doc_id; all columns stay."""
    found = classes_of(docs, least)
    first = found.groupBy("class").agg(F.min(F.struct((F.col("node") < NAMED).alias("unnamed"), "node", "key")).alias("f"))
    own_node, own_key = free_names(docs, "node", "key")
    first = first.select(F.col("f.node").alias(own_node), F.col("f.key").alias(own_key)).distinct()
    key, node = _key_and_node()
    keyed = docs.withColumns({own_key: key, own_node: node})
    return keyed.join(first, [own_node, own_key]).dropDuplicates([own_node, own_key]).select(*docs.columns)


def _rest(members: DataFrame, nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """All candidate pairs of different classes that can still be similar.

    A text shares with texts of other classes at most those of its k-mers that some other class holds.
    With c shared k-mers the similarity is at most c / (n + m - c), so most texts drop out here without
    being compared. For two texts c is at most what the histograms of those k-mers, by ``BINS`` hash
    bins, have in common, so pairs only arise where that bound leaves the question open. A pair is
    given by the first sketch it agrees on only.
    """
    open_texts = texts.join(members.select("node", "class").distinct(), "node")
    kmers = open_texts.select("node", "class", "text").mapInArrow(_kmers, "node long, class long, kmer long, n long")
    kmers = _saved(kmers, "kmers")
    shared = kmers.groupBy("kmer").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    bins = kmers.join(shared.select("kmer"), "kmer").groupBy("node", F.pmod("kmer", F.lit(BINS)).cast("int").alias("bin"))
    held = bins.agg(F.sum("n").cast("int").alias("n")).groupBy("node").agg(
        F.sum("n").alias("held"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin")
    )
    sized = nodes.select("node", "sketch", "n_kmers").join(held, "node").filter(F.col("held") >= least * F.col("n_kmers") - 1e-6)
    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    sized = sized.withColumn("bins", F.transform(every, lambda b: F.coalesce(F.try_element_at("by_bin", b), F.lit(0)))).drop("by_bin")
    kept = members.select("bucket", "node", "class").join(sized, "node")
    kept = _saved(kept, "kept")
    left, right = (kept.select("bucket", *[F.col(c).alias(f"{s}_{c}") for c in ("node", "class", "sketch", "n_kmers", "held", "bins")]) for s in "ab")
    both = F.col("a_n_kmers") + F.col("b_n_kmers")
    needed = least / (1 + least) * both - 1e-6
    agreed = F.array_position(F.zip_with("a_sketch", "b_sketch", lambda x, y: x == y), True)
    possible = (
        (left["bucket"] == right["bucket"])
        & (F.col("a_node") < F.col("b_node"))
        & (F.col("a_class") != F.col("b_class"))
        & (F.least("a_held", "b_held", "a_n_kmers", "b_n_kmers") >= needed)
        & (F.get("a_sketch", agreed.cast("int") - 1) == left["bucket"])
        & (F.aggregate(F.zip_with("a_bins", "b_bins", lambda x, y: F.least(x, y)), F.lit(0), lambda t, n: t + n) >= needed)
    )
    return left.join(right, possible).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
