"""Languages and scripts of documents, and exact copies.

A language is described by its letters, most frequent first, learned from labelled
documents. Letters of labelled text are counted by batches of texts, so that a few rows per
batch reach the shuffle. A text is counted in its own row, and shuffled as its distinct
letters once, which brings rows of one key together; it is then held against all
alphabets in batches, so nothing grows with texts times languages but the scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewloom.functions.texts import FAMILIES, accented_class

# Letters a layer needs, lowest score that counts, letters a language
# must share with a text, the alphabet size from which ranks are compared loosely,
# and the tolerances: ranks apart in a small alphabet, company of common letters
# before or after, and ranks apart as a share of a large alphabet.
MIN_LETTERS = 32
THRESHOLD = 0.1
MIN_OVERLAP = 0.2
SMALL_ALPHABET = 26
RANKS_APART = 4
COMPANY = 0.4
SHARE_APART = 3

#: A letter belongs to a language's alphabet if it makes up this share of its letters.
LEAST_SHARE = 0.0005

_LAYERS = [name for name in FAMILIES if name not in ("combining", "forms", "kana")]


#: ASCII without letters, one by one, which is a bit set to the regex engine.
_NO_ASCII_LETTERS = "".join(rf"\x{p:02X}" for p in range(0x80) if not chr(p).isalpha())


def letters_only(text: Column) -> Column:
    """The letters of a text in lower case."""
    return F.regexp_replace(F.lower(text), rf"[{_NO_ASCII_LETTERS}[\x{{80}}-\x{{10FFFF}}&&[^\p{{L}}]]]+", "")


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _sum_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each character occurs per language, summed within a batch."""
    for batch in batches:
        texts: dict[str | None, list[str]] = {}
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts.setdefault(language, []).append(text)
        rows = []
        for language, some in texts.items():
            counts = np.bincount(_code_points("".join(some)))
            found = np.flatnonzero(counts)
            rows += [(language, chr(point), n) for point, n in zip(found.tolist(), counts[found].tolist())]
        kinds = (batch.schema.types[0], pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["language", "letter", "n"])


def learn_letters(documents: DataFrame, text: str, language: str, share: float = LEAST_SHARE) -> DataFrame:
    """(language, letters): the letters that make up ``share`` of a language's text
    or more, the most frequent first, however many they are."""
    slim = documents.select(F.col(language).alias("language"), F.lower(text).alias("text")).filter(F.col("text") != "")
    kind = slim.schema["language"].dataType.simpleString()
    each = slim.mapInArrow(_sum_characters, f"language {kind}, letter string, n bigint")
    # Which characters are letters is asked of the few that there are.
    counted = each.filter(letters_only(F.col("letter")) != "").groupBy("language", "letter").agg(F.sum("n").alias("n"))
    # One row per language and letter from here on.
    whole = F.sum("n").over(Window.partitionBy("language"))
    kept = counted.withColumn("_all", whole).filter(F.col("n") >= share * F.col("_all"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "letter")))
    return kept.groupBy("language").agg(F.transform(ordered, lambda r: r["letter"]).alias("letters"))


#: Letters that are scored at once, of any number of texts.
SLICE = 1 << 18


@lru_cache(1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the script family (-1 for families that are passed over), and whether it has an
    accent. The first family that has a letter counts."""

    def ranges(chars: str):
        for low, high in re.findall(r"\\x\{([0-9A-F]+)\}(?:-\\x\{([0-9A-F]+)\})?", chars):
            yield slice(int(low, 16), int(high or low, 16) + 1)

    family, accented = np.full(0x110000, len(_LAYERS), np.int8), np.zeros(0x110000, bool)
    for name, chars in reversed(FAMILIES.items()):
        layer = "cjk" if name == "kana" else name
        for points in ranges(chars):
            family[points] = _LAYERS.index(layer) if layer in _LAYERS else -1
    for points in ranges(accented_class().split("&&", 1)[1]):
        accented[points] = True
    return family, accented


#: The letters of a text: code points, counts and first places.
_COUNTED = "struct<letter:array<int>,n:array<bigint>,place:array<int>>"
#: Code points up to which the counts of a text are an array.
_SMALL = 1 << 12


def _counted(texts: pa.Array) -> list[pa.Array]:
    """Each text as its distinct letters: code points, counts and first places."""
    columns: tuple[list, list, list] = ([], [], [])
    ends = [0]
    for text in texts.to_pylist():
        points = _code_points(text or "")
        if len(points) and points.max() < _SMALL:
            counts = np.bincount(points)
            letter = np.flatnonzero(counts)
            n, place = counts[letter], np.empty(len(counts), np.int64)
            place[points[::-1]] = np.arange(len(points) - 1, -1, -1)  # the last one written is the first place
            place = place[letter]
        else:
            letter, place, n = np.unique(points, return_index=True, return_counts=True)
        for column, values in zip(columns, (letter, n, place)):
            column.append(values)
        ends.append(ends[-1] + len(letter))
    kinds = (np.int32, np.int64, np.int32)
    offsets = pa.array(ends, pa.int32())
    return [
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, k), *c]).astype(k)))
        for c, k in zip(columns, kinds)
    ]


def letter_counts(text: Column) -> Column:
    """The distinct letters of a text, its own column: for :func:`language_scores` and :func:`text_letters`."""

    @F.arrow_udf(_COUNTED)
    def count(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_counted(texts), names=["letter", "n", "place"])

    return count(letters_only(text))


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *keys, text = batch.columns
        yield pa.RecordBatch.from_arrays([*keys, *_counted(text)], names=[*batch.schema.names[:-1], "letter", "n", "place"])


def text_letters(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(k0, k1, ..., letter, n, place): per key the letters (code points) of its texts with their counts and
    first places, as arrays. Rows of one key come as several arrays in one; a letter may be in each.
    ``text`` may be counted already, by :func:`letter_counts`."""
    names = [f"k{i}" for i in range(len(keep))]
    keys = [F.col(f"`{c}`").alias(k) for k, c in zip(names, keep)]
    if df.schema[text].dataType.simpleString() == _COUNTED:
        counted = df.filter(F.size(F.col(text)["letter"]) > 0).select(*keys, f"`{text}`.*")
    else:
        slim = df.select(*keys, letters_only(F.col(text)).alias("letters")).filter(F.col("letters") != "")
        kinds = "".join(f"{k} {df.schema[c].dataType.simpleString()}, " for k, c in zip(names, keep))
        counted = slim.mapInArrow(_count_letters, kinds + "letter array<int>, n array<bigint>, place array<int>")
    both = counted.groupBy(*names).agg(F.collect_list(F.struct("letter", "n", "place")).alias("rows"))
    return both.select(*names, *[F.flatten(f"rows.{c}").alias(c) for c in ("letter", "n", "place")])


def _runs(*sorted_by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted rows: where each group of equal rows begins, and the group of each row."""
    new = np.ones(len(sorted_by[0]), bool)
    new[1:] = np.logical_or.reduce([a[1:] != a[:-1] for a in sorted_by])
    return np.flatnonzero(new), np.cumsum(new) - 1


def _places(begins: np.ndarray, group: np.ndarray) -> np.ndarray:
    return np.arange(len(group)) - begins[group] if len(group) else group


def _earlier(group: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For rows sorted by group: how many rows before a row in its group have a smaller ``j`` (0, 1, ... in
    some order in each group). Counted bit by bit, as a merge sort would."""
    found = np.zeros(len(j), np.int64)
    width = int(j.max(initial=0)) + 1
    for bit in range(width.bit_length()):
        key = group * width + (j >> (bit + 1))
        order = np.argsort(key, kind="stable")
        clear = 1 - ((j[order] >> bit) & 1)
        begins, of = _runs(key[order])
        so_far = np.cumsum(clear) - clear
        found[order] += (1 - clear) * (so_far - so_far[begins][of])
    return found


def _layers(text: np.ndarray, letter: np.ndarray, n: np.ndarray, place: np.ndarray):
    """(text, letter, rank, found, accented, group): the letters of each text by frequency, ties by first
    occurrence, apart per script family if the text has letters beyond Latin. Layers of at most 32 letters
    are passed over."""
    family, has_accent = _characters()
    order = np.lexsort((letter, text))
    text, letter, n, place = (a[order] for a in (text, letter, n, place))
    begins, _ = _runs(text, letter)
    if len(begins):
        text, letter, n, place = text[begins], letter[begins], np.add.reduceat(n, begins), np.minimum.reduceat(place, begins)
    exotic = np.zeros(int(text.max(initial=0)) + 1, bool)
    exotic[text[letter >= 0x250]] = True
    layer = np.where(exotic[text], family[letter], 0)
    order = np.lexsort((place, -n, layer, text))
    order = order[layer[order] >= 0]
    text, letter, n, layer = (a[order] for a in (text, letter, n, layer))
    begins, group = _runs(text, layer)
    kept = np.bincount(group, n)[group] > MIN_LETTERS
    accented = np.bincount(group, has_accent[letter])[group] > 0
    rank, found = _places(begins, group), np.bincount(group)[group]
    return tuple(a[kept] for a in (text, letter, rank, found, accented, group))


def _score(alphabets: list[tuple], layers: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(text, score) of the layers that one language's alphabets (letters' places by code point, size, has
    an accent) fit. Several alphabets of one name count together."""
    text, letter, rank, found, accented, group = layers
    rows, there, size = [], [], []
    for place_of, length, has_accent in alphabets:
        at = place_of[np.minimum(letter, len(place_of) - 1)]
        met = np.flatnonzero((at >= 0) & (~accented | has_accent))
        rows.append(met)
        there.append(at[met])
        size.append(np.full(len(met), length, np.int64))
    row, there, size = (np.concatenate(a) for a in (rows, there, size))
    order = np.lexsort((there, row))
    row, there, size = row[order], there[order], size[order]
    kept = np.bincount(group[row], minlength=1)[group[row]] >= MIN_OVERLAP * size
    row, there, size = row[kept], there[kept], size[kept]
    if not len(row):
        return row, np.zeros(0)
    begins, of = _runs(group[row])
    m = np.bincount(of)[of]
    i, j = _places(begins, of), np.empty(len(row), np.int64)
    by_place = np.lexsort((there, of))
    j[by_place] = i
    before = _earlier(of, j)
    apart = np.abs(np.floor(rank[row] * size.astype(float) / found[row]) - there)
    # With the letter itself, those that stand after it by both orders, or at it.
    after = m - i - j + before
    company = (there == 0) | (before >= COMPANY * there) | (after >= COMPANY * (size - there))
    stands = np.where(size <= SMALL_ALPHABET, (apart <= RANKS_APART) & company, (apart < size / SHARE_APART) | company)
    first = row[begins]
    return text[first], np.bincount(of, stands) / found[first]


def _scorer(alphabets: list[tuple], keys: int):
    """Scores of texts against the alphabets (language, letters)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, has_accent = _characters()
        languages: dict[str | None, list] = {}
        for language, letters in alphabets:
            points = np.array([ord(c) for c in letters], np.int64)
            # One more than the last letter stands for all letters beyond.
            place_of = np.full(int(points.max(initial=0)) + 2, -1, np.int64)
            place_of[points] = np.arange(len(points))
            languages.setdefault(language, []).append((place_of, len(points), bool(has_accent[points].any())))
        for batch in batches:
            ends = batch.column(keys).offsets.to_numpy()[1:].astype(np.int64)
            ends = ends - batch.column(keys).offsets[0].as_py()
            start = 0
            while start < len(ends):
                base = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + SLICE, "right")))
                part = batch.slice(start, stop - start)
                letter, n, place = (part.column(keys + c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3))
                text = np.repeat(np.arange(stop - start), np.diff(ends[start:stop], prepend=base))
                layers = _layers(text, letter, n, place)
                for language, of in languages.items():
                    row, value = _score(of, layers)
                    row, value = row[value >= THRESHOLD], value[value >= THRESHOLD]
                    if len(row):
                        kept = [part.column(c).take(pa.array(row)) for c in range(keys)]
                        names = [*batch.schema.names[:keys], "language", "score"]
                        yield pa.RecordBatch.from_arrays([*kept, pa.array([language] * len(row), pa.string()), pa.array(value)], names=names)
                start = stop

    return score


def _before(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``i`` and ``j``, how many letters of the group stand before by rank and by place, and
    ``before``, how many do by both.

    The last is counted bit by bit of ``j``, as a merge sort would: a letter with bit b set comes after
    those that have it clear and the same higher bits. So a group of m letters costs m rows per bit.
    """
    group = Window.partitionBy(*keys)
    numbered = pairs.withColumns(
        {
            "i": F.row_number().over(group.orderBy("rank")) - 1,
            "j": F.row_number().over(group.orderBy("_there")) - 1,
            "m": F.count(F.lit(1)).over(group).cast("int"),
        }
    )
    bits = F.sequence(F.lit(0), F.length(F.bin(F.col("m"))))
    level = numbered.withColumn("_bit", F.explode(bits))
    is_set = F.expr("shiftright(j, _bit) % 2 = 1")
    level = level.withColumns({"_high": F.expr("shiftright(j, _bit + 1)"), "_set": is_set})
    earlier = Window.partitionBy(*keys, "_bit", "_high").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    level = level.withColumn("_clear", F.when(F.col("_set"), F.count_if(~F.col("_set")).over(earlier)).otherwise(0))
    rest = [c for c in numbered.columns if c not in (*keys, "i")]
    return level.groupBy(*keys, "i").agg(*[F.first(c).alias(c) for c in rest], F.sum("_clear").alias("before"))


def language_scores(df: DataFrame, text: str, table: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., language, score) for each language that fits a text, score rounded
    to 4 digits. Texts are scored per script family.

    The score is the share of a text's letters that stand where the language has
    them: at a similar rank, and with enough common letters before or after. The
    alphabets, a few letters per language, go to the workers with the function.
    """
    alphabets = [(r["language"], r["letters"]) for r in table.select("language", "letters").collect()]
    letters = text_letters(df, text, keep)
    names = letters.columns[: len(keep)]
    kinds = "".join(f"{k} {letters.schema[k].dataType.simpleString()}, " for k in names)
    scored = letters.mapInArrow(_scorer(alphabets, len(keep)), kinds + "language string, score double")
    return scored.select(*[F.col(k).alias(c) for k, c in zip(names, keep)], "language", F.round("score", 4).alias("score"))


def best_language(scores: DataFrame, keep: list[str]) -> DataFrame:
    """The highest score of each text, ties by name."""
    best = F.max_by(F.struct("language", "score"), F.struct("score", "language"))
    return scores.groupBy(*keep).agg(best.alias("b")).select(*keep, "b.language", "b.score")


def merge_scores(scores: DataFrame, keep: list[str]) -> DataFrame:
    """Average the scores of a text's chunks per language, then let alternative
    names (marked by an em dash) count for their base name with the larger score."""
    # As decimals, so that a half is rounded up whatever its binary form.
    mean = F.round(F.avg(F.col("score").cast("decimal(20,12)")), 4).cast("double")
    averaged = scores.groupBy(*keep, "language").agg(mean.alias("score"))
    base = F.replace("language", F.lit("—"), F.lit(""))
    return averaged.groupBy(*keep, base.alias("language")).agg(F.max("score").alias("score"))


# --- scripts --------------------------------------------------------------


def unicode_blocks(spark: SparkSession) -> DataFrame:
    """(bucket, block): the Unicode block of every 16 code points. The JVM knows the
    blocks; the table has 69,632 buckets at most, whatever the data."""
    point = F.col("id").cast("int")
    raw = F.reflect(F.lit("java.lang.Character$UnicodeBlock"), F.lit("of"), point)
    title = F.initcap(F.replace(raw, F.lit("_"), F.lit(" ")))
    title = F.regexp_replace(title, r"(Extended|Forms|Extension) ([A-Z])$", "$1-$2")
    title = F.regexp_replace(F.regexp_replace(title, "^Latin 1 ", "Latin-1 "), "^Cyrillic Supplementary$", "Cyrillic Supplement")
    title = F.when(title == "Greek", "Greek and Coptic").otherwise(title)
    title = F.when(point < 32, "Control character").otherwise(title)
    return (
        spark.range(0, 0x110000, 16)
        .select((F.col("id") / 16).cast("int").alias("bucket"), title.alias("block"))
        .filter(F.col("block").isNotNull())
    )


def script_profile(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, blocks): the Unicode blocks of a text, sorted and distinct. ASCII is
    recognised by pattern; only the distinct other characters are looked up."""
    t = F.col(text)
    beyond = F.regexp_replace(t, r"[\x00-\x7F]+", "")
    plain = F.array_compact(
        F.array(
            F.when(t.rlike(r"[\x00-\x1F]"), "Control character"),
            F.when(t.rlike(r"[\x20-\x7F]"), "Basic Latin"),
        )
    )
    buckets = F.array_distinct(
        F.transform(F.array_distinct(F.split(beyond, "")), lambda c: F.floor(F.ascii(c) / 16).cast("int"))
    )
    seen = df.select(*key, plain.alias("_plain"), F.explode_outer(buckets).alias("bucket"))
    named = seen.join(F.broadcast(unicode_blocks(df.sparkSession)), "bucket", "left")
    found = F.when(F.col("bucket") >= 8, F.col("block"))
    return named.groupBy(*key).agg(
        F.array_sort(F.array_union(F.first("_plain"), F.collect_set(found))).alias("blocks")
    )


# --- copies ---------------------------------------------------------------


def fingerprint(text: Column) -> Column:
    """SHA-256 of the UTF-8 text."""
    return F.sha2(text, 256)


def copy_groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per distinct text: its fingerprint, how often it occurs and the
    smallest key. Copies combine before the shuffle, so many copies cost one row."""
    return df.groupBy(fingerprint(F.col(text)).alias("fingerprint")).agg(
        F.count(F.lit(1)).alias("copies"), F.min(key).alias("first_key")
    )
