"""J1 by dyadic prefixes: address ranges of any width, IPv4 and IPv6.

A range becomes the aligned blocks that cover it exactly, at most two for each
bit (``cover``): one prefix where it is a block itself, else the blocks to the
right of its start's path and to the left of its end's path below their common
prefix. A block is (length, masked halves), so an address meets the blocks it
lies in by equality, once for each length that occurs in the cover: an equi-join
whatever the ranges' widths, where the block form of :mod:`daypulse.operators.geo`
explodes a /0 into 65,536 rows and knows IPv4 only. Work is linear in distinct
addresses x lengths in use (129 at most) + blocks; AQE splits a hot block.

Addresses are looked up once each and joined back by their halves. Of several
ranges that hold an address the one with the greatest start counts, then the
narrowest, then the greatest label; no range: ``unknown``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypulse.functions.net import MAPPED, halves_to_bits, ip_to_halves
from daypulse.operators.geo import UNKNOWN, valid_range

BITS = 128
RANGE = ("start_hi", "start_lo", "end_hi", "end_lo")


def ipv4_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges of IPv4 numbers (``start_ip``, ``end_ip``) as 128-bit ranges;
    those that are none are dropped."""
    zero = F.lit(0).cast("bigint")
    return ranges.where(valid_range()).select(
        zero.alias("start_hi"), (F.col("start_ip") + MAPPED).alias("start_lo"), zero.alias("end_hi"),
        (F.col("end_ip") + MAPPED).alias("end_lo"), "country", "local_city")


def text_ranges(ranges: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Ranges between two addresses in text, IPv4 or IPv6; those with an end
    that is no address are dropped."""
    at = ranges.withColumns({"_a": ip_to_halves(start), "_b": ip_to_halves(end)}).where("_a IS NOT NULL AND _b IS NOT NULL")
    return at.select(F.col("_a.hi").alias("start_hi"), F.col("_a.lo").alias("start_lo"), F.col("_b.hi").alias("end_hi"),
                     F.col("_b.lo").alias("end_lo"), "country", "local_city")


def common_bits(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    """Length of the common prefix of two addresses."""
    def leading(x: Column) -> Column:
        return F.when(x == 0, F.lit(64)).otherwise(64 - F.length(F.bin(x)))

    x, y = hi.bitwiseXOR(other_hi), lo.bitwiseXOR(other_lo)
    return F.when(x == 0, 64 + leading(y)).otherwise(leading(x)).cast("int")


def cover_bits(start: Column, end: Column, p: Column) -> Column:
    """The prefixes (texts of bits) whose blocks make up start..end, both of
    them bit texts of one length with ``p`` common bits in front; an empty list
    if start is beyond end."""
    zeros, ones = F.length(F.rtrim(start, F.lit("0"))), F.length(F.rtrim(end, F.lit("1")))
    whole = (zeros <= p) & (ones <= p)  # the range is the common prefix's block

    def siblings(path: Column, own: Column, bit: str, other: str) -> Column:
        # Blocks beside the path from below the split down to its last turn, and the block that ends it.
        depth = F.greatest(own, p + 1)
        turns = F.filter(F.sequence(p + 2, F.greatest(depth, p + 2)), lambda i: (i <= depth) & (F.substr(path, i, F.lit(1)) == bit))
        return F.concat(F.transform(turns, lambda i: F.concat(F.substr(path, F.lit(1), i - 1), F.lit(other))),
                        F.array(F.substr(path, F.lit(1), depth)))

    both = F.concat(siblings(start, zeros, "0", "1"), siblings(end, ones, "1", "0"))
    none = F.array().cast("array<string>")
    return F.when(start > end, none).when(whole, F.array(F.substr(start, F.lit(1), p))).otherwise(both)


def cover(ranges: DataFrame) -> DataFrame:
    """One row for each block of each range: len, hi, lo (zeros behind the
    prefix), with the range's other columns and its bits, ``_start`` and ``_end``."""
    bits = ranges.withColumns({"_start": halves_to_bits(F.col("start_hi"), F.col("start_lo")),
                               "_end": halves_to_bits(F.col("end_hi"), F.col("end_lo"))})
    same = common_bits(*map(F.col, RANGE))
    blocks = bits.withColumn("_p", F.explode(cover_bits(F.col("_start"), F.col("_end"), same)))
    full = F.rpad("_p", BITS, "0")

    def half(at: int) -> Column:
        return F.conv(F.substring(full, at, 64), 2, -10).cast("bigint")

    return blocks.select(*ranges.columns, "_start", "_end", F.length("_p").alias("len"), half(1).alias("hi"), half(65).alias("lo"))


def _mask(bits: Column) -> Column:
    """A half with its first ``bits`` bits set."""
    return (F.when(bits <= 0, F.lit(0).cast("bigint")).when(bits >= 64, F.lit(-1).cast("bigint"))
            .otherwise(F.call_function("shiftleft", F.lit(-1).cast("bigint"), (64 - bits).cast("int"))))


def locate(addresses: DataFrame, ranges: DataFrame, address: str = "ip") -> DataFrame:
    """Distinct addresses -> (``address``, location)."""
    blocks = cover(ranges).select(
        "len", "hi", "lo", F.struct("_start", F.translate("_end", "01", "10").alias("_narrow"),
                                    F.concat_ws(" ", "country", "local_city").alias("label")).alias("_hit"))
    lengths = blocks.agg(F.sort_array(F.collect_set("len")).alias("lens")).scalar()  # 129 numbers at most
    known = addresses.select(F.col(address).alias("_address")).distinct().withColumn("_at", ip_to_halves("_address"))
    probes = known.withColumn("_lens", lengths).select("_address", "_at", F.explode("_lens").alias("len"))
    probes = probes.where("_at IS NOT NULL").select(
        "_address", "len", F.col("_at.hi").bitwiseAND(_mask(F.col("len"))).alias("hi"),
        F.col("_at.lo").bitwiseAND(_mask(F.col("len") - 64)).alias("lo"))
    best = probes.join(blocks, ["len", "hi", "lo"]).groupBy("_address").agg(F.max("_hit")["label"].alias("location"))
    found = known.select("_address").join(best, "_address", "left")
    return found.select(F.col("_address").alias(address), F.coalesce("location", F.lit(UNKNOWN)).alias("location"))
