"""Packing documents into sequences of fixed length by repeated length patterns.

The lengths' histogram (at most as many rows as a sequence has tokens) goes to the driver. Patterns of
one to three lengths that fill a sequence are enumerated, non-negative least squares fits how often
each is used, the counts are rounded down to what the histogram has, and what remains is packed by
best fit, still on counts. Every piece then finds its place from its rank among the pieces of equal
length: no row of the data leaves the cluster.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.arrays import pieces, texts_of, with_short_batches
from viewloom.llm.bpe import ENCODED, default_path, shared_encoder, with_end
from viewloom.session import scratch_path

#: Ranks among equal lengths are counted in so many parts, as one length may hold a third of all rows.
SALTS = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, end: int, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path)
        for table in pieces(batches, limit=ENCODED):
            ids, at = with_end(*encoder.encode(texts_of(table.column("text"))), end)
            raw = memoryview(ids.astype("<u4").tobytes())
            n = np.diff(at)
            count = -(-n // size)
            head = n - (count - 1) * size
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            length = np.where(piece == 0, head[doc], size)
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * size)
            place = at[doc] + start
            crcs = [zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(place.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [table.column("doc_id").combine_chunks().take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def cut_pieces(docs: DataFrame, size: int, path: str, end: int) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32); the first piece of a long document is the short one."""
    return with_short_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_cut(path, end, size), PIECES)


def patterns_of(size: int) -> np.ndarray:
    """All ways to fill ``size`` by one, two or three lengths, as rows a >= b >= c (0: unused)."""
    rows = [np.array([[size, 0, 0]])]
    b = np.arange(1, size // 2 + 1)
    rows.append(np.stack([size - b, b, 0 * b], axis=1))
    for c in range(1, size // 3 + 1):
        b = np.arange(c, (size - c) // 2 + 1)
        rows.append(np.stack([size - c - b, b, np.full_like(b, c)], axis=1))
    return np.concatenate(rows)


def fit(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative repeat counts whose lengths approach the histogram in least squares, by
    multiplicative updates, which keep every count non-negative."""
    size = len(histogram)
    flat, used = patterns.ravel(), (patterns > 0).ravel()
    wanted = histogram.astype(float)
    wanted[0] = 0
    aim = wanted[patterns].sum(axis=1)
    x = np.where(aim > 0, aim / max(1.0, aim.max()), 0.0)
    for _ in range(rounds):
        made = np.bincount(flat, np.repeat(x, 3) * used, size)
        made[0] = 0
        below = made[patterns].sum(axis=1)
        x = x * np.divide(aim, below, out=np.zeros_like(aim), where=below > 0)
    return x


def plan(histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, how many sequences) that use each piece of the histogram once."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[tuple[int, ...], int]] = []
    if left[size]:
        out.append(((size,), int(left[size])))
        left[size] = 0
    patterns = patterns_of(size)[1:]
    patterns = patterns[(left[patterns] > 0)[:, :2].all(axis=1) & ((patterns[:, 2] == 0) | (left[patterns[:, 2]] > 0))]
    for kept in (len(patterns), 4 * size):  # all patterns, then the most used ones alone
        if not len(patterns):
            break
        counts = fit(patterns, left)
        order = np.argsort(-counts, kind="stable")[:kept]
        patterns, counts = patterns[order], counts[order]
    if len(patterns):
        for pattern, n in zip(patterns.tolist(), np.floor(counts + 1e-9).astype(np.int64).tolist()):
            lengths = tuple(v for v in pattern if v)
            n = min([n, *(int(left[v]) // lengths.count(v) for v in lengths)])
            if n > 0:
                out.append((lengths, n))
                for v in lengths:
                    left[v] -= n
    return out + best_fit(left, size)


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: open sequences are kept as groups of equal content."""
    room: list[dict[tuple[int, ...], int]] = [{} for _ in range(size + 1)]
    for v in range(size, 0, -1):
        n = int(left[v])
        for r in range(v, size):
            fits = r // v  # the room left by one piece is the best fit of the next, until it is too small
            while n and room[r]:
                held, m = room[r].popitem()
                copies = min(n, fits)
                take = min(n // copies, m)
                if m > take:
                    room[r][held] = m - take
                key = held + (v,) * copies
                room[r - copies * v][key] = room[r - copies * v].get(key, 0) + take
                n -= take * copies
            if not n:
                break
        while n:
            fits = size // v
            whole, rest = divmod(n, fits)
            if whole:
                key = (v,) * fits
                room[size - fits * v][key] = room[size - fits * v].get(key, 0) + whole
                n = rest
            else:
                key = (v,) * n
                room[size - n * v][key] = room[size - n * v].get(key, 0) + 1
                n = 0
    return [(k, m) for r in room for k, m in r.items()]


def _slots(made: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For ranges of ranks within a length: length, first rank, first sequence, offset; sorted."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in made:
        offset = 0
        for v in lengths:
            rank = used.get(v, 0)
            rows.append((v, rank, sequence, offset))
            used[v] = rank + n
            offset += v
        sequence += n
    rows.sort()
    return tuple(np.array(x, np.int64) for x in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))


def _place(slots):
    length, rank, sequence, offset = slots

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (length << 44) + rank
        for batch in batches:
            mine = batch.column("rank").to_numpy(zero_copy_only=False)
            i = np.searchsorted(keys, (batch.column("length").to_numpy(zero_copy_only=False) << 44) + mine, "right") - 1
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence[i] + mine - rank[i]), pa.array(offset[i])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return place


def assign(cut: DataFrame, size: int) -> DataFrame:
    """Give every piece its sequence and offset. ``cut`` must read the same rows each time."""
    histogram = np.zeros(size + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most ``size`` rows
        histogram[length] = n
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS))
    keyed = cut.withColumn("salt", salt)
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    parts = keyed.groupBy("length", "salt").count()  # at most size * SALTS rows
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = keyed.withColumn("own", F.row_number().over(own) - 1).join(parts, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own")).alias("rank"))
    return ranked.mapInArrow(_place(_slots(plan(histogram, size))), PIECES + ", sequence_id long, offset long")


def pack(docs: DataFrame, size: int = 1024, path: str | None = None, end: int = 2) -> DataFrame:
    """Pack every whole text into sequences of at most ``size`` tokens; one row per piece.

    Null text counts as empty (the end id only); rows with equal or null ids stay separate rows; an
    empty table gives no rows; other columns are ignored. The pieces (no texts) are written once to
    the shared folder, since their histogram and their places must come from the same rows.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "pieces")
    cut_pieces(docs, size, path or default_path("byte_bpe_50k.json"), end).write.mode("overwrite").parquet(folder)
    return assign(spark.read.parquet(folder), size)
