"""Removal of repeated passages: every window of consecutive words that also starts earlier goes.

Each window's minimiser is the group of words in it with the smallest hash. Consecutive windows that
share one travel together as a packed string to the bucket of that minimiser, so equal windows meet
in one bucket and a text is sent about three times, not twenty. In a bucket the windows are sorted
and compared word by word; only the first keeps its place.

A window that already occurred in the same piece of the scan is dropped from the packed strings and
marked on the spot. So a passage that a third of all documents share reaches its bucket once per
piece, however often it occurs. Strings of one piece and bucket are joined and compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.arrays import SPACES, Texts, Words, mix, owner, pieces, rolling, spread, texts_of, with_short_batches, words_of

#: Text of one piece of the scan, and packed text that a bucket sorts at once.
PIECE = 8 << 20
SORTED = 4 << 20
#: Words of the group whose hash picks the minimiser, and how hard packed strings are compressed.
GROUP = 4
LEVEL = 5

PACKED = "bucket int, packed binary"
REPEATS = "doc_id long, known boolean, mark long, start long, n long"


def word_hashes(words: Words) -> np.ndarray:
    """One 64-bit hash per word."""
    values = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.vocabulary), np.uint64, len(words.vocabulary))
    return values[words.codes] if len(values) else np.zeros(0, np.uint64)


def _starts(words: Words, width: int) -> np.ndarray:
    """Word numbers at which a window of ``width`` words of one text begins."""
    n = np.maximum(np.diff(words.first) - width + 1, 0)
    return spread(words.first[:-1], n)


def _equal_neighbours(codes: np.ndarray, width: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the windows starting at ``left`` and ``right`` hold the same words."""
    same = np.ones(len(left), bool)
    for j in range(width):
        same &= codes[left + j] == codes[right + j]
    return same


def _repeated(codes: np.ndarray, hashes: np.ndarray, width: int, starts: np.ndarray) -> np.ndarray:
    """Marks the windows equal to an earlier one. ``starts`` come in document order, ``hashes`` are theirs."""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    tie = np.flatnonzero(hashes[1:] == hashes[:-1])
    out = np.zeros(len(starts), bool)
    if not len(tie):
        return out
    same = _equal_neighbours(codes, width, starts[order[tie]], starts[order[tie + 1]])
    out[order[tie[same] + 1]] = True
    for place in tie[~same].tolist():  # two windows with one hash: settle that run of hashes by its words
        a = place
        while a and hashes[a - 1] == hashes[place]:
            a -= 1
        b = place
        while b + 1 < len(hashes) and hashes[b + 1] == hashes[place]:
            b += 1
        seen: set[bytes] = set()
        for i in order[a : b + 1].tolist():
            window = codes[starts[i] : starts[i] + width].tobytes()
            out[i] = window in seen
            seen.add(window)
    return out


def _joined(starts: np.ndarray, *breaks: np.ndarray) -> np.ndarray:
    """Marks where a run of consecutive window starts begins; a change in any of ``breaks`` splits too."""
    fresh = np.ones(len(starts), bool)
    fresh[1:] = starts[1:] != starts[:-1] + 1
    for b in breaks:
        fresh[1:] |= b[1:] != b[:-1]
    return fresh


def _minimisers(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window start the smallest hash of the word groups within it."""
    group = min(GROUP, width)
    groups = rolling(hashes, group)
    span = width - group + 1
    best, have = groups, 1
    while have < span:
        step = min(have, span - have)
        best = np.minimum(best[: len(best) - step], best[step:])
        have += step
    return best


def _pack(width: int, buckets: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PIECE):
            # In document order, as "earlier" is judged by document and place.
            piece = piece.sort_by([("known", "ascending"), ("doc_id", "ascending"), ("mark", "ascending")])
            texts = texts_of(piece.column("text"))
            words = words_of(texts, ~SPACES)
            starts = _starts(words, width)
            if not len(starts):
                continue
            hashes = word_hashes(words)
            windows = rolling(hashes, width)[starts]
            repeated = _repeated(words.codes, windows, width, starts)
            ids, known, marks = (piece.column(c).to_numpy() for c in ("doc_id", "known", "mark"))
            doc = owner(words.first)
            # Equal rows are one document: a window never counts as earlier than itself.
            twin = np.zeros(len(ids), bool)
            twin[1:] = (ids[1:] == ids[:-1]) & (known[1:] == known[:-1]) & (marks[1:] == marks[:-1])
            keep = ~twin[doc[starts]]
            starts, windows, repeated = starts[keep], windows[keep], repeated[keep]
            if twin.any():
                repeated = _repeated(words.codes, windows, width, starts)
            gone = starts[repeated]
            if len(gone):
                begin = np.flatnonzero(_joined(gone, doc[gone]))
                n = np.diff(np.append(begin, len(gone)))
                d, first = doc[gone[begin]], gone[begin]
                yield _packed_rows([-1], [_blob(ids[d], known[d], marks[d], first - words.first[d], n, [])])
            sent = starts[~repeated]
            lowest = _minimisers(hashes, width)[sent]
            begin = np.flatnonzero(_joined(sent, lowest, doc[sent]))
            n = np.diff(np.append(begin, len(sent)))
            first, d = sent[begin], doc[sent[begin]]
            bucket = (mix(lowest[begin]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            first, d, n, bucket = first[order], d[order], n[order], bucket[order]
            left, right = words.starts[first], words.ends[first + n + width - 2]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1))
            blobs = []
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(bucket)]):
                strings = [texts.data[x:y].tobytes() for x, y in zip(left[a:b].tolist(), right[a:b].tolist())]
                part = slice(a, b)
                blobs.append(_blob(ids[d[part]], known[d[part]], marks[d[part]], first[part] - words.first[d[part]], n[part], strings))
            yield _packed_rows(bucket[edges].tolist(), blobs)

    return pack


def _packed_rows(buckets: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "packed"])


def _blob(ids, known, marks, starts, n, strings: list[bytes]) -> bytes:
    """Runs of windows, with their packed strings if they are to be compared, compressed."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    columns = [np.asarray(c, np.int64).tobytes() for c in (ids, known, marks, starts, n)]
    raw = b"".join([len(ids).to_bytes(8, "little"), len(strings).to_bytes(8, "little"), *columns, lengths.tobytes(), *strings])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", LEVEL).compress(raw, asbytes=True)


def _open(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The run columns (5 x runs), string lengths and joined strings of a blob."""
    raw = np.frombuffer(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd"), np.uint8)
    rows, strings = raw[:16].view(np.int64)
    columns = raw[16 : 16 + 40 * rows].view(np.int64).reshape(5, rows)
    at = 16 + 40 * rows
    return columns, raw[at : at + 8 * strings].view(np.int64), raw[at + 8 * strings :]


def _runs_of(columns: np.ndarray) -> pa.RecordBatch:
    ids, known, marks, starts, n = columns
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(known.astype(bool)), pa.array(marks), pa.array(starts), pa.array(n)],
        names=["doc_id", "known", "mark", "start", "n"],
    )


def _compare(opened: list[tuple], width: int) -> pa.RecordBatch | None:
    """Runs of windows in these packed strings that are not the first of their words."""
    columns = np.concatenate([c for c, _, _ in opened], axis=1)
    lengths = np.concatenate([n for _, n, _ in opened])
    data = np.concatenate([s for _, _, s in opened])
    ids, known, marks, starts, n = columns
    at = np.concatenate([[0], np.cumsum(lengths)])
    words = words_of(Texts(data, at), ~SPACES)
    if not len(words.codes):
        return None
    # Windows in document order: run by run, as runs of one document follow its words.
    by_doc = np.lexsort((starts, marks, ids, known))
    run = np.repeat(by_doc, n[by_doc])
    place = spread(np.zeros(len(by_doc), np.int64), n[by_doc])
    overlap = (np.diff(np.stack([ids, known, marks])[:, by_doc]) == 0).all(axis=0)
    if (overlap & (starts[by_doc][1:] < (starts + n)[by_doc][:-1])).any():
        # Equal rows of the table came in different pieces: keep each window of that document once.
        window = np.stack([known[run], ids[run], marks[run], starts[run] + place])
        order = np.lexsort(window[::-1])
        once = np.ones(len(order), bool)
        once[1:] = (np.diff(window[:, order]) != 0).any(axis=0)
        run, place = run[order[once]], place[order[once]]
    begins = words.first[run] + place
    hashes = rolling(word_hashes(words), width)[begins]
    again = _repeated(words.codes, hashes, width, begins)
    run, place = run[again], place[again]
    if not len(run):
        return None
    begin = np.flatnonzero(_joined(place, run))
    return _runs_of(np.stack([ids[run[begin]], known[run[begin]], marks[run[begin]], starts[run[begin]] + place[begin], np.diff(np.append(begin, len(run)))]))


def _sort(width: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, current = 0, None
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("packed")):
                opened = _open(blob.as_buffer().to_pybytes())
                if bucket < 0:
                    yield _runs_of(opened[0])
                    continue
                # A bucket is compared as a whole; small ones share a sort.
                if bucket != current and size >= SORTED:
                    found = _compare(held, width)
                    if found is not None:
                        yield found
                    held, size = [], 0
                current = bucket
                held.append(opened)
                size += len(opened[2])
        if held:
            found = _compare(held, width)
            if found is not None:
                yield found

    return sort


def repeats(docs: DataFrame, width: int = 20, buckets: int | None = None) -> DataFrame:
    """Runs (doc_id, known, mark, start, n): ``n`` windows from word ``start`` on that occur earlier.

    ``docs`` has doc_id, known, mark (a hash of the text) and text. ``known`` is false for null ids,
    which come first. Buckets are many more than partitions, so that a task sorts few at a time.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * tasks
    packed = docs.mapInArrow(_pack(width, buckets), PACKED)
    # Every task gets as many buckets; runs that need no comparing are dealt by their content.
    task = F.pmod(F.when(F.col("bucket") < 0, F.xxhash64("packed")).otherwise(F.col("bucket")), F.lit(tasks)).cast("int")
    return packed.repartitionById(tasks, task).sortWithinPartitions("bucket").mapInArrow(_sort(width), REPEATS)


def _kept(width: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            texts = texts_of(piece.column("text"))
            words = words_of(texts, ~SPACES)
            n_words = np.diff(words.first)
            runs = piece.column("runs").combine_chunks()
            values = runs.flatten()
            counts = np.diff(np.concatenate([[0], np.cumsum(np.asarray(runs.value_lengths().fill_null(0)))]))
            doc = np.repeat(np.arange(piece.num_rows), counts)
            begin = words.first[doc] + values.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
            end = begin + values.field("n").to_numpy(zero_copy_only=False).astype(np.int64) + width - 1
            n = len(words.codes) + 1
            gone = np.cumsum(np.bincount(begin, minlength=n) - np.bincount(end, minlength=n))[:-1] > 0
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
            kept = []
            for i in range(piece.num_rows):
                a, b = words.first[i], words.first[i + 1]
                mine = words.codes[a:b][~gone[a:b]].tolist()
                kept.append(b" ".join([words.vocabulary[c] for c in mine]).decode())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").combine_chunks(), pa.array(n_words.astype(np.int64)), pa.array(removed), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return keep


def remove_repeats(docs: DataFrame, width: int = 20) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_text), one per document.

    A word goes if a window of ``width`` words over it also starts earlier: in a smaller doc_id, or
    before in the same document. Null ids come first; equal ids are ordered by a hash of the text,
    and rows equal in both count as one document. Null and short texts have no windows. Texts are
    judged whole and on the input; other columns are ignored.
    """
    base = with_short_batches(docs).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("known"),
        F.xxhash64("text").alias("mark"),
        F.col("text").cast("string").alias("text"),
    )
    found = repeats(base, width).groupBy("doc_id", "known", "mark").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = base.join(found, ["doc_id", "known", "mark"], "left").select(
        F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "text", "runs"
    )
    return joined.mapInArrow(_kept(width), "doc_id long, n_words long, n_removed long, kept_text string")
