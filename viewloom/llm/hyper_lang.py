"""Language of a text by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of an n-gram binds its letters: each is
rotated by its place and all are multiplied. A text is the bundle (the sum) of its n-grams, a language
prototype the bundle of its labelled texts, and a text gets the language of the nearest prototype by
cosine. Training gathers one vector per language and task, so nothing grows with the documents.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.arrays import carried_types, pieces, with_short_batches

DIMENSIONS = 1024
GRAM = 3
SEED = 7
#: Text worked on at once, n-gram vectors a worker remembers, and texts whose bundles are made together.
PIECE = 2 << 20
REMEMBERED = 40_000
TOGETHER = 32
UNKNOWN = "und"

PREDICTED = "held_out boolean, lang_pred string, score double"


class Grams:
    """Vectors of letters and n-grams, made when first seen and equal on every worker."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.is_letter = np.full(0x110000, -1, np.int8)
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.vectors = np.zeros((0, self.dimensions), np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            signs = np.random.default_rng([SEED, point]).integers(0, 2, self.dimensions, np.int8)
            self.letters[point] = signs * 2 - 1
        return self.letters[point]

    def bound(self, grams: list[int]) -> np.ndarray:
        """Vectors of n-grams: the product of their letters, each rotated by its distance from the end."""
        out = np.ones((len(grams), self.dimensions), np.int8)
        for i, gram in enumerate(grams):
            for place in range(GRAM):
                out[i] *= np.roll(self.letter((gram >> (21 * place)) & 0x1FFFFF), place)
        return out

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """The rows of ``vectors`` that hold these distinct n-grams."""
        wanted = grams.tolist()
        if len(self.known) + len(wanted) > REMEMBERED:
            self.forget()
        missing = [g for g in wanted if g not in self.known]
        if missing:
            self.known.update(zip(missing, range(len(self.known), len(self.known) + len(missing))))
            self.vectors = np.concatenate([self.vectors, self.bound(missing)])
        return np.fromiter(map(self.known.__getitem__, wanted), np.int64, len(wanted))

    def of_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-grams; for each n-gram in the texts its number among them and its text.

        Letters are lower-cased, everything between letters counts as one space, and an n-gram has no
        space in its middle, so none runs over a word.
        """
        low = [t.lower() for t in texts]
        lengths = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
        joined = (" " + " ".join(low) + " ").encode("utf-32-le", "replace")
        points = np.frombuffer(joined, np.uint32).astype(np.int64)
        marks = self.is_letter[points]
        for p in np.unique(points[marks < 0]).tolist():
            self.is_letter[p] = unicodedata.category(chr(p))[0] == "L"
        letters = self.is_letter[points] > 0
        kept = letters.copy()
        kept[1:] |= letters[:-1]
        kept[0] = True
        text = np.repeat(np.arange(len(low)), lengths)
        text = np.concatenate([[0], text, [len(low) - 1] if len(low) else []]).astype(np.int64)[: len(points)]
        points, text = np.where(letters, points, 0x20)[kept], text[kept]
        middle = points[1:-1] != 0x20
        codes = ((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])[middle]
        number, distinct = pd.factorize(codes)
        return distinct, number, text[1:-1][middle]


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vector per language: the sum of the n-gram vectors of this task's labelled texts."""
    grams, sums = Grams(), {}
    for piece in pieces(batches, limit=PIECE):
        texts = [t or "" for t in piece.column("text").to_pylist()]
        langs = piece.column("lang").combine_chunks().dictionary_encode()
        names = langs.dictionary.to_pylist()
        distinct, number, text = grams.of_texts(texts)
        if not len(distinct):
            continue
        lang = langs.indices.to_numpy(zero_copy_only=False)[text]
        counts = np.bincount(lang * len(distinct) + number, minlength=len(names) * len(distinct)).reshape(len(names), -1)
        for at in range(0, len(distinct), 4096):
            rows = grams.rows(distinct[at : at + 4096])
            part = counts[:, at : at + 4096].astype(np.float64) @ grams.vectors[rows].astype(np.float64)
            for name, vector in zip(names, part):
                sums[name] = sums.get(name, 0) + vector
    for name, vector in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([vector], pa.list_(pa.float64()))], names=["lang", "vector"])


def _label(handed, carried: tuple[str, ...]):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prototypes = handed.value
        grams = Grams()
        for piece in pieces(batches, limit=PIECE):
            texts = [t or "" for t in piece.column("text").to_pylist()]
            distinct, number, text = grams.of_texts(texts)
            order = np.argsort(text, kind="stable") if len(text) and (np.diff(text) < 0).any() else slice(None)
            number, text = number[order], text[order]
            bounds = np.searchsorted(text, np.arange(len(texts) + 1))
            best, score = np.full(len(texts), -1), np.zeros(len(texts))
            for a in range(0, len(texts), TOGETHER):
                b = min(a + TOGETHER, len(texts))
                mine = number[bounds[a] : bounds[b]]
                if not len(mine) or not len(names):
                    continue
                own, used = pd.factorize(mine)
                counts = np.bincount((text[bounds[a] : bounds[b]] - a) * len(used) + own, minlength=(b - a) * len(used))
                counts = counts.reshape(b - a, len(used)).astype(np.float32)
                bundle = np.zeros((b - a, grams.dimensions), np.float32)
                for at in range(0, len(used), REMEMBERED // 2):  # more n-grams than are remembered go in parts
                    rows = grams.rows(distinct[used[at : at + REMEMBERED // 2]])
                    bundle += counts[:, at : at + REMEMBERED // 2] @ grams.vectors[rows].astype(np.float32)
                size = np.linalg.norm(bundle, axis=1)
                cosine = (bundle @ prototypes.T) / np.maximum(size, 1e-9)[:, None]
                best[a:b] = np.where(counts.any(axis=1), cosine.argmax(axis=1), -1)
                score[a:b] = np.where(counts.any(axis=1), cosine.max(axis=1), 0)
            labels = [names[i] if i >= 0 else UNKNOWN for i in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(c).combine_chunks() for c in (*carried, "held_out")] + [pa.array(labels, pa.string()), pa.array(np.clip(score.astype(float), 0, 1))],
                names=[*carried, "held_out", "lang_pred", "score"],
            )

    return label


def _held_out():
    """Documents kept out of training: crc32 of the id's text leaves 2 by 4. A null id is not one of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes, from all texts with a label that are not held out.

    The driver gets one vector per language; their number is that of the labels, not of documents.
    """
    picked = docs.filter(~_held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    parts = with_short_batches(picked).select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(_bundles, "lang string, vector array<double>")
    summed = parts.select("lang", F.posexplode("vector").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    vectors: dict[str, np.ndarray] = {}
    for lang, at, value in summed.collect():  # languages x dimensions
        vectors.setdefault(lang, np.zeros(DIMENSIONS))[at] = value
    names = sorted(vectors)
    prototypes = np.array([vectors[n] / max(np.linalg.norm(vectors[n]), 1e-9) for n in names]).reshape(len(names), DIMENSIONS)
    return names, prototypes.astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None, carried: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Rows (doc_id, text, held_out, lang_pred, score), one per document; ``carried`` names other columns to keep.

    Null texts and texts without letters are ``und`` with score 0, as is every text if there is no
    label to learn from. Ties go to the language that sorts first. Labels are used for learning only;
    null or repeated ids stay rows of their own; columns that are not carried are ignored.
    """
    handed = docs.sparkSession.sparkContext.broadcast(model or learn(docs))
    picked = docs.select(*carried, _held_out().alias("held_out"))
    return with_short_batches(picked).mapInArrow(_label(handed, carried), carried_types(docs, carried) + PREDICTED)
