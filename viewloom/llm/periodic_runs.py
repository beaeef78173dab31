"""Periodic runs of words, by uniting suffix classes in order of falling common prefixes.

Suffixes of a text that share their first ``l`` words form a class. Going from the largest ``l`` down,
classes are united along the suffix order (Kruskal's algorithm over the longest common prefixes), each
with its positions in order. Two positions that become neighbours in a class at ``l``, at a distance
``d`` within ``l``, mark a stretch of period ``d`` and length ``d + l``; it is a run if the word before it
breaks the period. Every run is found so, once, with its smallest period: were there a position between
the two with the first ``d`` words in common, those words would repeat a shorter group.

Suffixes are ordered for all texts of a piece together, by doubling, and only where the first words that
any wanted run needs occur again in the same text. A class that has no two positions near enough for a
run at any ``l`` is left out before the union.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.arrays import SPACES, Words, carried_types, mix, owner, pieces, rolling, texts_of, with_short_batches, words_of

LEAST_LENGTH = 6
LEAST_REPEATS = 4
#: Text of one piece, and positions of one block of an ordered set.
PIECE = 2 << 20
BLOCK = 1024

FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Places:
    """An ordered set of positions, in blocks, so that adding one never moves many."""

    __slots__ = ("blocks", "lows", "size")

    def __init__(self, place: int):
        self.blocks, self.lows, self.size = [[place]], [place], 1

    def add(self, place: int) -> None:
        at = max(bisect_right(self.lows, place) - 1, 0)
        block = self.blocks[at]
        insort(block, place)
        self.lows[at] = block[0]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[at : at + 1] = block[:BLOCK], block[BLOCK:]
            self.lows.insert(at + 1, block[BLOCK])

    def around(self, place: int) -> tuple[int | None, int | None]:
        """The neighbours of a position of the set."""
        at = bisect_right(self.lows, place) - 1
        block = self.blocks[at]
        i = bisect_left(block, place)
        before = block[i - 1] if i else (self.blocks[at - 1][-1] if at else None)
        if i + 1 < len(block):
            return before, block[i + 1]
        return before, self.blocks[at + 1][0] if at + 1 < len(self.blocks) else None

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def least_shared(least_length: int, least_repeats: int) -> int:
    """The fewest words that the two suffixes of a wanted run share: its length without one period."""
    return min(max(least_length - q, (least_repeats - 1) * q) for q in range(1, max(least_length, 2)))


def suffix_order(codes: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, as far as they share ``width`` words or more with a
    neighbour in the same text, and how many words each shares with the one before it (0 where a class
    of ``width`` words begins). A suffix ends with its text."""
    none = np.zeros(0, np.int64)
    n = len(codes)
    if n <= width:
        return none, none
    # Positions whose first words occur again; equal hashes of different words cost time only.
    first = mix(codes.astype(np.uint64) + np.uint64(1)) ^ mix(text.astype(np.uint64) + np.uint64(1 << 40))
    inside = np.flatnonzero(text[: n - width + 1] == text[width - 1 :])
    hashes = rolling(first, width)[inside]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twin = np.zeros(len(order), bool)
    twin[1:] |= same
    twin[:-1] |= same
    marked = np.zeros(n, bool)
    marked[inside[order[twin]]] = True
    if not marked.any():
        return none, none
    # The words behind them decide their order too.
    wide = marked.copy()
    for j in range(1, width + 1):
        wide[j:] |= marked[:-j] & (text[j:] == text[:-j])
    places = np.flatnonzero(wide)
    slot = np.full(n + 1, -1, np.int64)
    slot[places] = np.arange(len(places))

    def ahead(k: int) -> np.ndarray:
        """Places k words on, or n beyond the text's end."""
        to = np.minimum(places + k, n - 1)
        return np.where((places + k < n) & (text[to] == text[places]), to, n)

    padded = np.append(codes, -1)
    columns = [padded[ahead(j)] for j in range(width - 1, 0, -1)] + [codes[places], text[places]]
    order = np.lexsort(columns)
    fresh = np.ones(len(order), bool)
    fresh[1:] = False
    for c in columns:
        fresh[1:] |= c[order][1:] != c[order][:-1]
    rank = np.empty(len(order), np.int64)
    begins = np.flatnonzero(fresh)
    rank[order] = begins[np.cumsum(fresh) - 1]
    levels, span = [(width, rank)], width
    while True:
        sizes = np.diff(np.append(begins, len(order)))
        open_ = np.flatnonzero(np.repeat(sizes > 1, sizes))  # places in the order still tied
        if not len(open_):
            break
        mine = order[open_]
        step = ahead(span)[mine]
        key = np.where(step == n, -1, rank[slot[np.minimum(step, n - 1)]])
        by = np.lexsort((key, rank[mine]))
        order[open_], key = mine[by], key[by]
        split = key[1:] != key[:-1]
        fresh[open_[1:][split]] = True
        begins = np.flatnonzero(fresh)
        if not split.any():
            break
        rank = rank.copy()
        rank[order] = begins[np.cumsum(fresh) - 1]
        span *= 2
        levels.append((span, rank))
    # Common prefixes of neighbours, from the widest ranks down to single words.
    shared = np.zeros(len(order), np.int64)
    pair = np.flatnonzero(levels[0][1][order][1:] == levels[0][1][order][:-1]) + 1
    a, b = places[order[pair - 1]], places[order[pair]]
    length = np.zeros(len(pair), np.int64)

    def advance(step: int, equal: np.ndarray) -> None:
        """Move the pairs marked equal by as many words; beyond a text's end is n."""
        for x in (a, b):
            at = x[equal]
            to = np.minimum(at + step, n - 1)
            x[equal] = np.where((at + step < n) & (text[to] == text[at]), to, n)
        length[equal] += step

    for step, ranks in reversed(levels):
        live = (a < n) & (b < n)
        one, two = slot[np.where(live, a, n)], slot[np.where(live, b, n)]
        advance(step, live & (one >= 0) & (two >= 0) & (ranks[one] == ranks[two]))
    equal = np.ones(len(pair), bool)
    for _ in range(width - 1):
        equal = equal & (a < n) & (b < n)
        equal[equal] = codes[a[equal]] == codes[b[equal]]
        advance(1, equal)
    shared[pair] = length
    return places[order], shared


def seeds(order: np.ndarray, shared: np.ndarray, least_length: int, least_repeats: int) -> np.ndarray:
    """Rows (first position, distance, shared words) of neighbours in a class that mark wanted runs."""
    if not len(order):
        return np.zeros((0, 3), np.int64)
    # Classes at the least width: no seed where even the nearest two positions are too far apart.
    begins = np.flatnonzero(shared == 0)
    number = np.cumsum(shared == 0) - 1
    most = np.maximum.reduceat(shared, begins)
    by = np.lexsort((order, number))
    gap = np.full(len(order), np.iinfo(np.int64).max // 4)
    gap[1:] = np.where(number[by][1:] == number[by][:-1], np.diff(order[by]), gap[0])
    nearest = np.minimum.reduceat(gap, begins)
    worth = ((least_repeats - 1) * nearest <= most)[number]
    edge = np.flatnonzero((shared > 0) & worth)
    edge = edge[np.argsort(-shared[edge], kind="stable")]
    levels = np.flatnonzero(np.diff(shared[edge], prepend=-1))
    left, right, words = order[edge - 1].tolist(), order[edge].tolist(), shared[edge].tolist()
    above: dict[int, int] = {}
    places: dict[int, Places] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = above[x]
        return x

    out: dict[tuple[int, int], int] = {}
    for begin, end in zip(levels.tolist(), [*levels[1:].tolist(), len(edge)]):
        common = words[begin]
        added: list[int] = []
        for i in range(begin, end):
            a, b = top(left[i]), top(right[i])
            one = places.get(a) or Places(a)
            two = places.get(b) or Places(b)
            if one.size < two.size:
                a, b, one, two = b, a, two, one
            for place in two:
                one.add(place)
                added.append(place)
            places.pop(b, None)
            above[b] = a
            places[a] = one
        # Neighbours after all unions of the level; those that were neighbours before keep their first.
        for place in added:
            before, after = places[top(place)].around(place)
            if before is not None and (least_repeats - 1) * (place - before) <= common:
                out.setdefault((before, place - before), common)
            if after is not None and (least_repeats - 1) * (after - place) <= common:
                out.setdefault((place, after - place), common)
    found = np.array([(*pair, common) for pair, common in out.items()], np.int64).reshape(-1, 3)
    return found[found[:, 1] + found[:, 2] >= least_length]


def runs_of(words: Words, least_length: int = LEAST_LENGTH, least_repeats: int = LEAST_REPEATS) -> np.ndarray:
    """Rows (first word in the piece, length, period) of the runs of all texts, by first word and period."""
    text = owner(words.first)
    codes = np.asarray(words.codes, np.int64)
    order, shared = suffix_order(codes, text, least_shared(least_length, least_repeats))
    place, period, common = seeds(order, shared, least_length, least_repeats).T
    before = np.maximum(place - 1, 0)
    starts = (place == words.first[text[place]]) | (codes[before] != codes[before + period])
    found = np.stack([place, common + period, period], axis=1)[starts]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _find(least_length: int, least_repeats: int, carried: tuple[str, ...]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PIECE):
            texts = texts_of(piece.column("text"))
            words = words_of(texts, ~SPACES)
            found = runs_of(words, least_length, least_repeats) if len(words.codes) else np.zeros((0, 3), np.int64)
            start, length, period = found.T
            doc = owner(words.first)[start]
            n = len(words.codes) + 1
            gone = np.cumsum(np.bincount(start + period, minlength=n) - np.bincount(start + length, minlength=n))[:-1] > 0
            runs = pa.StructArray.from_arrays(
                [pa.array(start - words.first[doc]), pa.array(length), pa.array(period)], names=["start", "length", "period"]
            )
            offsets = np.searchsorted(doc, np.arange(piece.num_rows + 1)).astype(np.int32)
            collapsed = []
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                mine = words.codes[a:b]
                mine = mine[~gone[a:b]] if gone[a:b].any() else mine
                collapsed.append(b" ".join(map(words.vocabulary.__getitem__, mine.tolist())))
            yield pa.RecordBatch.from_arrays(
                [piece.column(c).combine_chunks() for c in carried]
                + [pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(offsets), runs), pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=[*carried, "n_words", "runs", "collapsed"],
            )

    return find


def periodic_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, least_repeats: int = LEAST_REPEATS, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (doc_id, n_words, runs, collapsed), one per document; ``carried`` names other columns to keep.

    A run is a stretch of words with smallest period q, of ``least_length`` words or more and at least
    ``least_repeats`` (2 or more) periods, that no neighbouring word extends; ``runs`` lists them by start,
    then period, and they may overlap. ``collapsed`` has the words that no run covers after its first q,
    joined by one space. Words are parted by ASCII white space. Null and empty texts have no words and
    ``collapsed`` is empty. Each row is a document of its own, whatever its id; texts are taken whole and
    never meet each other; columns that are not carried are ignored.
    """
    if least_repeats < 2:
        raise ValueError("a run has at least two periods")
    picked = with_short_batches(docs).select(*carried, F.col("text").cast("string").alias("text"))
    if "text" in carried:
        picked = docs.select(*carried)
    return picked.mapInArrow(_find(least_length, least_repeats, carried), carried_types(docs, carried) + FOUND)
