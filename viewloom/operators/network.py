"""IPv4 addresses and blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ip_number(ip: Column) -> Column:
    """A dotted IPv4 address as a number; null when it is none."""
    parts = F.transform(F.split(ip, r"\."), lambda p: p.try_cast("int"))
    legal = ip.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & F.forall(parts, lambda p: p.between(0, 255))
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, p: total * 256 + p)
    return F.when(legal, number)


def block_bits(block: Column) -> Column:
    """Prefix length of ``a.b.c.d/n``; null when the block is not valid (n is 1 to 32)."""
    bits = F.regexp_extract(block, r"^[^/]+/(\d{1,2})$", 1).try_cast("int")
    return F.when(bits.between(1, 32) & ip_number(F.substring_index(block, "/", 1)).isNotNull(), bits)


def network_of(number: Column, bits: Column) -> Column:
    """The address with everything after the prefix cleared."""
    size = F.pow(F.lit(2.0), 32 - bits).cast("bigint")
    return number - F.pmod(number, size)


def in_block(ip: Column, block: Column) -> Column:
    bits = block_bits(block)
    return network_of(ip_number(ip), bits) == network_of(ip_number(F.substring_index(block, "/", 1)), bits)


def match_blocks(df: DataFrame, ip: str, blocks: DataFrame, label: str = "label") -> DataFrame:
    """Left join each row to its most specific block (longest prefix, then the
    greatest label). ``blocks`` has ``block`` and the label.

    Only prefix lengths that occur (at most 32) are tried, each as an equality on
    the network number. Addresses are matched once per distinct value, so a busy
    address costs no more than a rare one.
    """
    known = (
        blocks.withColumn("_bits", block_bits(F.col("block")))
        .filter(F.col("_bits").isNotNull())
        .withColumn("_net", network_of(ip_number(F.substring_index("block", "/", 1)), F.col("_bits")))
        .groupBy("_bits", "_net")
        .agg(F.max(F.struct(F.col(label).alias("label"), F.col("block").alias("block"))).alias("_hit"))
    )
    lengths = sorted(r[0] for r in known.select("_bits").distinct().collect())
    addresses = df.select(F.col(ip)).distinct().withColumn("_number", ip_number(F.col(ip)))
    tried = addresses.withColumn(
        "_bits", F.explode(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"))
    ).withColumn("_net", network_of(F.col("_number"), F.col("_bits")))
    best = (
        tried.join(known, ["_bits", "_net"])
        .groupBy(ip)
        .agg(F.max(F.struct("_bits", "_hit")).alias("_best"))
        .select(ip, F.col("_best._hit.label").alias(label), F.col("_best._hit.block").alias("block"))
    )
    return df.join(best, ip, "left")
