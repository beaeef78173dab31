"""Quality of a text by the votes of its nearest labelled neighbours in a latent-semantic space.

A text's terms are the groups of three neighbouring bytes, hashed into a fixed number of counts, and
how often it repeats a word at once, a word at all, and a line. Counts are damped by their square root
and weighed by how few documents of the whole table have the term. The latent space is spanned by the
first singular vectors of the labelled texts. Every document is compared, in blocks, with all labelled
vectors by exact cosine, and its nearest neighbours vote with a power of their cosine as weight.

The vectors that are broadcast come from at most ``REFERENCES`` labelled rows, those with the smallest
hashes of their ids; the term weights count all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.arrays import SPACES, Texts, carried_types, mix, owner, pieces, runs, texts_of, with_short_batches

#: Labelled rows that become neighbours, counts of byte groups, dimensions of the latent space.
REFERENCES = 4096
GROUPS = 2048
DIMENSIONS = 64
#: Neighbours that vote, the power of their cosine, and how much a repetition counts beside a byte group.
NEIGHBOURS = 15
POWER = 4
REPEATED = 16
#: The least score of a text of good quality.
THRESHOLD = 0.3
#: Text of one piece, and texts compared together.
PIECE = 2 << 20
TOGETHER = 256
TERMS = GROUPS + 3

LINES = np.ones(256, bool)
LINES[0x0A] = False

SCORED = "score double"


@dataclass
class Model:
    """Term weights, the latent space, the labelled unit vectors in it, their labels, and the share of
    label 1, which is the score of a text that resembles none of them."""

    weights: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were needed so far."""

    BASE = np.uint64(0x9E3779B97F4A7C15)
    INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) <= n:
            for name, base in (("up", self.BASE), ("down", self.INVERSE)):
                values = np.full(n + 1, base, np.uint64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))


_POWERS = _Powers()


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per byte range, equal for equal bytes wherever they stand."""
    _POWERS.upto(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * _POWERS.down[starts])


def _again(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text, how many of its runs of marked bytes equal the run before, and any run before."""
    starts, ends = runs(inside[texts.data], texts.at)
    hashes = _hashes(texts.data, starts, ends)
    first = np.searchsorted(starts, texts.at)
    text = owner(first)
    following = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    # A stable sort keeps the runs of a text together among equal ones.
    order = np.argsort(hashes, kind="stable")
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    n = len(texts)
    return np.bincount(text[1:][following], minlength=n), np.bincount(text[order][1:][same], minlength=n)


def term_counts(texts: Texts) -> Iterator[np.ndarray]:
    """Counts of the terms, texts x terms, of ``TOGETHER`` texts at a time; all 0 for an empty text."""
    at_once, words = _again(texts, ~SPACES)
    _, lines = _again(texts, LINES)
    repeats = REPEATED * np.stack([at_once, words, lines], axis=1)
    lengths = np.diff(texts.at)
    for a in range(0, len(texts), TOGETHER):
        b = min(a + TOGETHER, len(texts))
        # Each text has two spaces before and after it, so a group at its edge differs from one within.
        data = np.frombuffer(b"  ".join([b"", *map(texts.bytes_of, range(a, b)), b""]), np.uint8).astype(np.uint32)
        groups = data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA6B) + data[2:] * np.uint32(0xC2B2AE35)
        groups ^= groups >> np.uint32(15)
        groups *= np.uint32(0x2C1B3C6D)
        groups ^= groups >> np.uint32(13)
        text = np.repeat(np.arange(b - a, dtype=np.int64), lengths[a:b] + 2)
        counts = np.zeros((b - a, TERMS), np.float32)
        place = text * GROUPS + (groups[: len(text)] & np.uint32(GROUPS - 1))
        counts[:, :GROUPS] = np.bincount(place, minlength=(b - a) * GROUPS).reshape(b - a, GROUPS)
        counts[:, GROUPS:] = repeats[a:b]
        counts[lengths[a:b] == 0] = 0
        yield counts


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _documents_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of this task have each term."""
    found, n = np.zeros(TERMS, np.int64), 0
    for piece in pieces(batches, limit=PIECE):
        n += piece.num_rows
        for counts in term_counts(texts_of(piece.column("text"))):
            found += (counts > 0).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, TERMS)), pa.array([n, *found.tolist()])], names=["term", "n"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, limit=PIECE):
        labels = piece.column("label").combine_chunks()
        for at, counts in enumerate(term_counts(texts_of(piece.column("text")))):
            values = pa.FixedSizeListArray.from_arrays(pa.array(counts.ravel()), TERMS).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([labels.slice(at * TOGETHER, len(counts)), values], names=["label", "counts"])


def held_out(parts: int = 5) -> Column:
    """Documents whose label is never learned from: crc32 of the id's text is divisible by ``parts``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", references: int = REFERENCES) -> Model:
    """The model from labelled rows that are not held out.

    At most ``references`` ids are used, those with the smallest hashes. An id with several labels has
    the smallest of them, one with several texts the smallest of those. The driver gets one number per
    term, and one vector of term counts for each of the labelled rows.
    """
    text = with_short_batches(docs).select(F.col("text").cast("string").alias("text"))
    found = text.mapInArrow(_documents_with, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    have = dict.fromkeys(range(-1, TERMS), 0) | {r["term"]: r["n"] for r in found}
    weights = np.log([(1 + have[-1]) / (1 + have[t]) for t in range(TERMS)]).astype(np.float32)
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    # Bounded by the parameter, whatever the number of labels or documents.
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(references)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
    table = chosen.orderBy("doc_id").select("text", "label").mapInArrow(_counts, "label int, counts array<float>").toArrow()
    if not table.num_rows:
        return Model(weights, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0, np.float32), 0.5)
    counts = table.column("counts").combine_chunks().flatten().to_numpy().reshape(-1, TERMS)
    marks = (table.column("label").to_numpy() == 1).astype(np.float32)
    rows = _unit(np.sqrt(counts) * weights)
    strength, axes = np.linalg.eigh((rows.T @ rows).astype(np.float64))
    strength, axes = strength[::-1][:DIMENSIONS], axes[:, ::-1][:, :DIMENSIONS]
    space = axes[:, strength > 1e-6 * max(strength[0], 1e-9)].astype(np.float32)
    return Model(weights, space, _unit(rows @ space), marks, float(marks.mean()))


def votes(model: Model, counts: np.ndarray) -> np.ndarray:
    """The weighted share of label 1 among each text's nearest neighbours; equally near ones all vote."""
    out = np.full(len(counts), model.prior)
    if not len(model.labels):
        return out
    vectors = _unit((_unit(np.sqrt(counts) * model.weights)) @ model.space)
    near = np.round(vectors @ model.vectors.T, 5)
    n = min(NEIGHBOURS, near.shape[1])
    least = np.partition(near, near.shape[1] - n, axis=1)[:, near.shape[1] - n]
    weight = np.where(near >= least[:, None], np.maximum(near, 0), 0) ** POWER
    total = weight.sum(axis=1)
    voted = total > 0
    out[voted] = (weight @ model.labels)[voted] / total[voted]
    return np.clip(np.round(out, 5), 0, 1)


def _score(handed, carried: tuple[str, ...]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handed.value
        for piece in pieces(batches, limit=PIECE):
            scores = [votes(model, counts) for counts in term_counts(texts_of(piece.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [piece.column(c).combine_chunks() for c in carried] + [pa.array(np.concatenate(scores), pa.float64())], names=[*carried, "score"]
            )

    return score


def score_quality(docs: DataFrame, labels: DataFrame | None = None, model: Model | None = None, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per document; ``carried`` names other columns to keep.

    The score is the share of label 1 among the neighbours; ``predicted`` is 1 from ``THRESHOLD`` on. Null
    and empty texts, and texts that resemble no labelled one, have the share of label 1 among all labelled
    rows used; without labels everything scores 0.5. Each row is scored by its text alone, so equal texts
    score alike; columns that are not carried are ignored.
    """
    handed = docs.sparkSession.sparkContext.broadcast(model or learn(docs, labels))
    text = F.col("text").cast("string").alias("text")
    plain = [c for c in carried if c not in ("text", "doc_id")]
    picked = with_short_batches(docs).select("doc_id", text, *plain)
    names = ("doc_id", *[c for c in carried if c != "doc_id"])
    scored = picked.mapInArrow(_score(handed, names), carried_types(picked, names) + SCORED)
    return scored.select(*names, held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
