"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every shingle of five words is hashed once. The top bits of the hash choose one of ``BINS`` bins, the
smallest hash stays. An empty bin copies a filled one, which it picks by its own random order of the
bins (a two-universal map, so copies are independent of each other). Of each bin the low ``BITS`` bits
are stored; the likeness of two fingerprints corrects for bits that agree by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.functions.binding import let

BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8
SHINGLE = 5
#: A prime above BINS: the maps c -> (a * c + b) mod PRIME order the bins.
PRIME = 131

_BLANKS = "\t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Words between ASCII white space; null text has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), _BLANKS, " " * len(_BLANKS))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def shingles(text: Column) -> Column:
    """One hash per run of five words; a shorter text is one shingle, an empty one none."""

    def of(hashes: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - SHINGLE),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(SHINGLE)]),
        )
        short = F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(hashes) >= SHINGLE, runs).otherwise(short)

    return let(F.transform(words_of(text), lambda w: F.xxhash64(w)), of)


def _bin(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - BIN_BITS).cast("int")


def _smallest(hashes: Column) -> Column:
    """The smallest hash of each bin that has any: the first of its bin once all are sorted."""
    return let(
        F.sort_array(hashes),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))),
    )


def _filled(minima: Column) -> Column:
    """The low bits of every bin in order, empty bins filled from others."""

    def with_bins(bins: Column) -> Column:
        def donor(b: Column) -> Column:
            a = F.pmod(F.xxhash64(b, F.lit(1)), F.lit(PRIME - 1)) + 1
            c = F.pmod(F.xxhash64(b, F.lit(2)), F.lit(PRIME))
            ranked = lambda a, c: F.array_min(F.transform(bins, lambda x, i: ((a * x + c) % PRIME) * BINS + i))
            return let(F.struct(a.alias("a"), c.alias("c")), lambda k: ranked(k["a"], k["c"])) % BINS

        def value(b: Column) -> Column:
            own = F.array_position(bins, b).cast("int") - 1
            place = let(own, lambda p: F.when(p >= 0, p).otherwise(donor(b).cast("int")))
            return F.get(minima, place).bitwiseAND(F.lit((1 << BITS) - 1)).cast("smallint")

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)

    filled = let(F.transform(minima, _bin), with_bins)
    return F.when(F.size(minima) > 0, filled).otherwise(F.array().cast("array<smallint>"))


def sketch(text: Column) -> Column:
    """Low bits of the bins; an empty array for a text without words."""
    return let(_smallest(shingles(text)), _filled)


def packed(bits: Column) -> Column:
    """The stored form: two hexadecimal digits per bin; an empty string for a text without words."""
    return F.array_join(F.transform(bits, lambda v: F.lpad(F.lower(F.hex(v.cast("int"))), BITS // 4, "0")), "")


def likeness(left: Column, right: Column) -> Column:
    """Estimated share of common shingles, 0 to 1. Two texts without words are alike, one is not."""
    same = F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda v: v)) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    corrected = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    empty = (F.size(left) == 0).cast("int") + (F.size(right) == 0).cast("int")
    return F.when(empty == 2, 1.0).when(empty == 1, 0.0).otherwise(corrected)


def with_next(docs: DataFrame, derived: dict[str, Column], blocks: int | None = None) -> DataFrame:
    """Add the ``derived`` columns and ``next``, a struct of the next row's text and derived columns by
    (doc_id, text); the first row follows the last.

    Rows are dealt into blocks of neighbouring ids and numbered inside a block, so one shuffle moves
    each row once and no task sees all of them. A block's last row takes the first row of the block
    after it; those first rows are as many as there are blocks.
    """
    spark = docs.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / blocks for i in range(1, blocks)]
    borders = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * blocks)).alias("b")).first()["b"] if shares else []
    borders = F.lit(",".join(map(str, sorted(set(borders or [])))))
    borders = F.when(borders == "", F.array().cast("array<bigint>")).otherwise(F.split(borders, ",").cast("array<bigint>"))
    # The number of borders not above the id; null ids, which come first, are in the first block.
    block = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(borders, lambda b: b <= F.col("doc_id"))))
    dealt = docs.withColumn("_block", block)
    window = Window.partitionBy("_block").orderBy("doc_id", "text")
    row = F.struct("text", *derived)
    numbered = dealt.withColumns(derived).withColumn("_own", F.lead(row).over(window)).withColumn("_last", F.col("_own").isNull())

    # The first row of each block: its id (one row per block, so small enough to send everywhere), then the row.
    ids = dealt.groupBy("_block").agg(F.min(F.struct("doc_id")).alias("_id"))
    ids = F.broadcast(ids.select(F.col("_block").alias("_b"), F.col("_id.doc_id").alias("_id")))
    heads = dealt.join(ids, (F.col("_block") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    heads = heads.groupBy("_block").agg(F.min(F.struct("doc_id", "text")).alias("_head"))
    heads = heads.select("_block", "_head.text").withColumns(derived).select("_block", row.alias("_row"))
    in_order = Window.orderBy("_block")
    around = F.first("_row").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select(F.col("_block").alias("_b"), F.coalesce(F.lead("_row").over(in_order), around).alias("_after"))
    joined = numbered.join(after, F.col("_last") & (F.col("_block") == F.col("_b")), "left")
    return joined.withColumn("next", F.coalesce("_own", "_after")).drop("_block", "_own", "_last", "_b", "_after")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_chars, text, bits, edited, edited_bits, next_bits), one per document.

    ``edited`` is the text with its last half (rounded down) replaced by the start of the next
    document's. Null text counts as empty; null ids come first and equal ids go by text; a table of
    one row is its own next; other columns are ignored.
    """
    picked = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(picked, {"bits": sketch(F.col("text"))})
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next.text", F.lit(1), half))
    rows = rows.select("doc_id", size.cast("long").alias("n_chars"), "text", "bits", edited.alias("edited"), F.col("next.bits").alias("next_bits"))
    return rows.withColumn("edited_bits", sketch(F.col("edited")))
