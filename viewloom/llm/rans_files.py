"""Token ids in static range-ANS files, written in document order and read back in parallel.

A stored row is one self-contained file: a frequency table shared by all its blocks, the documents'
ids and lengths, and independent blocks. A block holds ``LANES`` interleaved coder states; the words
of all lanes form one stream. The block index is the list of checkpoints: where a block's tokens and
words start, its lane states, and a checksum of its tokens, so any block is decoded alone.

The files travel as rows of a Parquet table below ``spark.checkpoint.dir``: Spark's writer commits
them, so a lost executor's half-written files are never seen, and any store Spark can write will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.arrays import pieces, texts_of, with_short_batches
from viewloom.llm.bpe import ENCODED, default_path, shared_encoder, with_end
from viewloom.session import scratch_path

MAGIC = b"RANSTOK1"
#: Frequencies of a file sum to 2**SCALE; states stay in [LOW, LOW << 32).
SCALE = 20
LOW = 1 << 31
LANES = 1024
#: Tokens of a block: a multiple of LANES.
BLOCK = 256 * LANES
#: Tokens of a file, about; a longer document makes a longer file.
FILE_TOKENS = 16 * BLOCK
#: Ids below this are looked up in a dense table, larger ones by search.
DENSE = 1 << 22

FILES = "part int, segment int, start long, tokens long, file binary"
ROWS = "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and their frequencies, each at least 1, summing to 2**SCALE."""
    counts = np.bincount(ids) if len(ids) and int(ids.max()) < DENSE else None
    if counts is None:
        symbols, counts = np.unique(ids, return_counts=True)
    else:
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
    total = 1 << SCALE
    if not len(symbols):
        return symbols.astype(np.uint32), counts.astype(np.uint64)
    if len(symbols) > total // 2:
        raise ValueError("more distinct ids than the frequency table can hold")
    freq = np.maximum(1, counts * total // max(1, counts.sum()))
    over = int(freq.sum()) - total
    if over > 0:  # take from the largest, which can spare it
        for i in np.argsort(-freq, kind="stable"):
            take = min(over, int(freq[i]) - 1)
            freq[i] -= take
            over -= take
            if not over:
                break
    else:
        freq[np.argmax(freq)] -= over
    return symbols.astype(np.uint32), freq.astype(np.uint64)


def _encode_blocks(codes: np.ndarray, freq: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States, words and words per block of all blocks at once; ``codes`` has shape (blocks, steps, lanes)."""
    blocks, steps, lanes = codes.shape
    state = np.full((blocks, lanes), LOW, np.uint64)
    shift, scale = np.uint64(32), np.uint64(SCALE)
    limit = freq << np.uint64(31 - SCALE + 32)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for t in range(steps - 1, -1, -1):
        c = codes[:, t]
        f = freq[c]
        full = state >= limit[c]
        out.append((state[full].astype(np.uint32), full.sum(axis=1)))
        state = np.where(full, state >> shift, state)
        q = state // f
        state = (q << scale) + (state - q * f) + low[c]
    out.reverse()
    per_step = np.array([n for _, n in out]).reshape(steps, blocks)
    words = np.concatenate([w for w, _ in out]) if out else np.zeros(0, np.uint32)
    # Words come step by step over all blocks; each block wants its own, in step order.
    belongs = np.repeat(np.tile(np.arange(blocks), steps), per_step.ravel())
    return state, words[np.argsort(belongs, kind="stable")], per_step.sum(axis=0)


def _decode_blocks(states: np.ndarray, words: list[np.ndarray], steps: int, freq, low, table) -> np.ndarray:
    """Codes of shape (blocks, steps, lanes) from lane states and the words of each block."""
    blocks, lanes = states.shape
    state = states.copy()
    stream = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64)
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])])[:-1]
    out = np.empty((blocks, steps, lanes), np.uint32)
    mask, shift, scale = np.uint64((1 << SCALE) - 1), np.uint64(32), np.uint64(SCALE)
    for t in range(steps):
        slot = state & mask
        c = table[slot]
        out[:, t] = c
        state = freq[c] * (state >> scale) + slot - low[c]
        short = state < np.uint64(LOW)
        taken = np.cumsum(short, axis=1)
        place = at[:, None] + taken - 1
        state[short] = (state[short] << shift) | stream[place[short]]
        at = at + taken[:, -1]
    return out


def pack_file(doc_ids: np.ndarray, known: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: documents (id, whether it is known, length) and all their token ids."""
    symbols, freq = frequencies(ids)
    low = np.cumsum(freq) - freq
    if len(symbols) and int(symbols[-1]) < DENSE:
        place = np.zeros(int(symbols[-1]) + 1, np.uint32)
        place[symbols] = np.arange(len(symbols), dtype=np.uint32)
        codes = place[ids]
    else:
        codes = np.searchsorted(symbols, ids).astype(np.uint32)
    blocks = -(-len(ids) // BLOCK)
    head = struct.pack("<8sIIQQ", MAGIC, len(symbols), blocks, len(doc_ids), len(ids))
    parts = [head, symbols.astype("<u4").tobytes(), freq.astype("<u4").tobytes()]
    parts += [doc_ids.astype("<i8").tobytes(), known.astype("u1").tobytes(), lengths.astype("<u8").tobytes()]
    index, streams = [], []
    common = int(np.argmax(freq)) if len(freq) else 0
    for full in (True, False):  # whole blocks together, then the last one with only the steps it needs
        whole = len(ids) // BLOCK
        first, n = (0, whole) if full else (whole, blocks - whole)
        if not n:
            continue
        part = codes[first * BLOCK : (first + n) * BLOCK]
        steps = -(-(len(part) // n if full else len(part)) // LANES)
        padded = np.full(n * steps * LANES, common, np.uint32)
        padded[: len(part)] = part
        states, words, counts = _encode_blocks(padded.reshape(n, steps, LANES), freq, low)
        ends = np.cumsum(counts)
        for b in range(n):
            start = (first + b) * BLOCK
            tokens = ids[start : start + BLOCK]
            crc = zlib.crc32(tokens.astype("<u4").tobytes())
            index.append(struct.pack("<QQII", start, len(tokens), int(counts[b]), crc) + states[b].astype("<u8").tobytes())
            streams.append(words[ends[b] - counts[b] : ends[b]].astype("<u4").tobytes())
    return b"".join([*parts, *index, *streams])


def unpack_file(blob: bytes, wanted: range | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, whether they are known, lengths, and the tokens of the blocks ``wanted`` (all by default)."""
    magic, n_symbols, blocks, n_docs, n_ids = struct.unpack_from("<8sIIQQ", blob)
    if magic != MAGIC:
        raise ValueError("not a token file")
    place = struct.calcsize("<8sIIQQ")

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal place
        found = np.frombuffer(blob, kind, n, place)
        place += found.nbytes
        return found

    symbols, freq = take("<u4", n_symbols), take("<u4", n_symbols).astype(np.uint64)
    doc_ids, known, lengths = take("<i8", n_docs), take("u1", n_docs).astype(bool), take("<u8", n_docs).astype(np.int64)
    low = np.cumsum(freq) - freq
    checkpoints = []
    for _ in range(blocks):
        start, tokens, words, crc = struct.unpack_from("<QQII", blob, place)
        place += 24
        checkpoints.append((tokens, words, crc, take("<u8", LANES).astype(np.uint64)))
    streams = [take("<u4", words) for _, words, _, _ in checkpoints]
    chosen = list(range(blocks) if wanted is None else wanted)
    table = np.repeat(np.arange(n_symbols, dtype=np.uint32), freq.astype(np.int64))
    out: dict[int, np.ndarray] = {}
    by_steps: dict[int, list[int]] = {}
    for b in chosen:
        by_steps.setdefault(-(-checkpoints[b][0] // LANES), []).append(b)
    for steps, group in by_steps.items():
        codes = _decode_blocks(np.stack([checkpoints[b][3] for b in group]), [streams[b] for b in group], steps, freq, low, table)
        for b, c in zip(group, codes):
            tokens = symbols[c.ravel()[: checkpoints[b][0]]]
            if zlib.crc32(tokens.astype("<u4").tobytes()) != checkpoints[b][2]:
                raise ValueError(f"block {b} does not match its checksum")
            out[b] = tokens
    ids = np.concatenate([out[b] for b in chosen]) if chosen else np.zeros(0, np.uint32)
    return doc_ids, known, lengths, ids


def _files(path: str, end: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), shared_encoder(path)
        held: list[tuple] = []
        size = start = segment = 0

        def close() -> pa.RecordBatch:
            nonlocal held, size, start, segment
            known, docs, lengths, ids = (np.concatenate(x) for x in zip(*held))
            blob = pack_file(docs, known, lengths, ids)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([blob], pa.binary())],
                names=["part", "segment", "start", "tokens", "file"],
            )
            start, segment, size, held = start + len(ids), segment + 1, 0, []
            return row

        for table in pieces(batches, limit=ENCODED):
            ids, at = with_end(*encoder.encode(texts_of(table.column("text"))), end)
            docs = table.column("doc_id").combine_chunks()
            held.append((docs.is_valid().to_numpy(zero_copy_only=False), docs.fill_null(0).to_numpy(), np.diff(at), ids))
            size += len(ids)
            if size >= FILE_TOKENS:
                yield close()
        if held:
            yield close()

    return write


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, start, blob in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist(), batch.column("file")):
            docs, known, lengths, ids = unpack_file(blob.as_buffer().to_pybytes())
            ends = np.cumsum(lengths)
            raw = memoryview(ids.astype("<u4").tobytes())
            crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(docs), part, np.int32)), pa.array(docs, mask=~known), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())],
                names=["part", "doc_id", "local_start", "n_tokens", "ids_crc32"],
            )


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end: int = 2) -> str:
    """Encode every whole text and write token files in ascending ``doc_id`` order (null first, equal
    ids by text). Null text counts as empty: only the end id. Other columns are ignored.

    One range shuffle moves each text once; part p holds smaller ids than part p + 1.
    """
    ordered = with_short_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(_files(path or default_path("word_bpe_49k.json"), end), FILES)
    files.write.option("compression", "none").mode("overwrite").parquet(folder)
    return folder


def read_token_files(spark, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) decoded from the files. ``start`` counts the ids of
    all documents before; the sums per part are few rows, as many as the writer had tasks."""
    files = spark.read.parquet(folder)
    parts = files.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))
    rows = files.select("part", "start", "file").mapInArrow(_rows, ROWS)
    return rows.join(parts, "part").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, path: str | None = None, end: int = 2) -> DataFrame:
    """Write token files into a fresh shared folder and return what reading them back gives."""
    folder = write_token_files(docs, scratch_path(docs.sparkSession, "token-files"), path, end)
    return read_token_files(docs.sparkSession, folder)
