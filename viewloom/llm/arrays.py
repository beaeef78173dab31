"""Byte, word and ragged-array helpers for the operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text of one working piece; a longer document is a piece of its own.
PIECE_BYTES = 3 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Texts:
    """UTF-8 texts one after the other: text i is data[at[i]:at[i + 1]]."""

    data: np.ndarray
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.at[i] : self.at[i + 1]].tobytes()


@dataclass
class Words:
    """Words of several texts: byte ranges, the first word of each text, and codes into a vocabulary."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    codes: np.ndarray
    vocabulary: list[bytes]


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8).copy()
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(raw, at - at[0])


def with_short_batches(df):
    """The frame, after making Arrow batches short enough for long texts: a batch of the default
    number of rows would take tens of megabytes twice per task, outside the heap. A number that the
    session sets itself is kept."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")
    return df


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.Table]:
    """Re-cut batches into tables of about ``limit`` bytes of text, so that memory stays bounded."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0).cast(pa.int64()))
        start = 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > limit:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                pa.default_memory_pool().release_unused()
                held, size, start = [], 0, i
            size += n + 16
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run never crosses the border of a text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    edges = at[at < len(inside)]
    before[edges] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def encode_slices(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Codes and distinct values of the byte strings between neighbouring cuts of ``data``."""
    column = pa.Array.from_buffers(
        pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), pa.py_buffer(data)]
    )
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def words_of(texts: Texts, inside: np.ndarray) -> Words:
    """Runs of the bytes marked in the table ``inside`` as words, coded by a vocabulary of their own."""
    kept = inside[texts.data]
    starts, ends = runs(kept, texts.at)
    cuts = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=cuts[1:])
    codes, vocabulary = encode_slices(texts.data[kept], cuts)
    return Words(starts, ends, np.searchsorted(starts, texts.at), codes, vocabulary)


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices first[i], first[i] + 1, ... of ``counts[i]`` values each, joined."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(first - (ends - counts), counts)


def owner(first: np.ndarray) -> np.ndarray:
    """For borders first[0] <= first[1] <= ...: which part each element belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive 64-bit values; one result per start, shorter input gives none."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + values[j : j + n]
    return mix(out)


def carried_types(docs, names: Iterable[str]) -> str:
    """The columns an operator passes through, as the front part of its result's schema."""
    return "".join(f"`{n}` {docs.schema[n].dataType.simpleString()}, " for n in names)


def free_names(docs, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from the columns."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
