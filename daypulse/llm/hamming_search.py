"""Exact top-k of binary codes by incremental multi-index hashing.

A 64-bit code is split into m segments of about log2(n) bits (Norouzi et al.,
2014), and every distinct code is indexed under each segment's value. Round s
probes, for every query that is still open, all values that differ from the
query's segment in exactly s bits, in all segments, and verifies the distance
of what it finds. After round s all codes within m (s + 1) - 1 bits have been
found, since a farther spread leaves no segment within s; a query closes when
its kth verified distance is within that radius, or when the radius covers the
whole segment. Nothing is capped: a query without near neighbours runs on.

Equal codes are one entry of the index, with their k smallest ids kept beside
it, so a code that many rows share is probed once; equal query codes are
searched once. A pair of codes passes in the first segment and round in which it
meets, and what moves is at most k of a query from each task; a segment value
that many codes share is compared in the join, which AQE splits.

Defined results: distance ties go to the smaller id; a row is its own neighbour
at distance 0 if it is among the rows searched; rows with a null id or a null
code take no part; repeated rows count once; with fewer than k rows all are
returned; empty tables give an empty table; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm.storage import materialise

BITS = 64


def sign_code(vector: Column) -> Column:
    """Bit i of a code tells whether component i (of the first 64) is above
    zero; null and NaN components are not. Null for a null vector."""
    return F.aggregate(F.slice(F.transform(vector, lambda x, i: F.struct(
        F.coalesce((x > 0) & ~F.isnan(x), F.lit(False)).cast("long").alias("v"), i.alias("i"))), 1, BITS),
        F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(F.call_function("shiftleft", x["v"], x["i"])))


def segments(n: int) -> list[tuple[int, int]]:
    """(offset, width) of the segments for n codes."""
    m = min(BITS, max(1, ceil(BITS / max(1.0, log2(max(2, n))))))
    cuts = [BITS * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _value(code: Column, offset: int, width: int) -> Column:
    value = F.shiftrightunsigned(code, offset)
    return value if width == BITS else value.bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _probes(queries: DataFrame, parts: list[tuple[int, int]], radius: int) -> DataFrame:
    """(seg, value, qcode, bound) for all values exactly ``radius`` bits away."""
    def moved(seg: int, offset: int, width: int, masks: list[int]) -> Column:
        own = _value(F.col("qcode"), offset, width)
        return F.transform(F.from_json(F.lit(str(masks)), "array<bigint>"),
                           lambda m: F.struct(F.lit(seg).alias("seg"), own.bitwiseXOR(m).alias("value")))

    every = [(seg, o, w, [_signed(sum(1 << b for b in c)) for c in combinations(range(w), radius)])
             for seg, (o, w) in enumerate(parts)]
    out = [moved(*x) for x in every if x[3]]
    return queries.select("qcode", "bound", F.explode(F.concat(*out)).alias("p")).select(
        F.col("p.seg").alias("seg"), F.col("p.value").alias("value"), "qcode", "bound")


def _first_met(parts: list[tuple[int, int]], radius: int) -> Column:
    """Whether a pair meets in this segment for the first time: no segment is
    nearer than ``radius`` (it met in an earlier round), none before this one as
    near. So each pair passes once, no shuffle has to take out repeats, and a
    task keeps its k nearest of a query before anything moves."""
    met = F.lit(True)
    for i, (o, w) in enumerate(parts):
        d = F.bit_count(_value(F.col("qcode").bitwiseXOR(F.col("code")), o, w))
        met = met & F.when(F.col("p.seg") > i, d > radius).otherwise(d >= radius)
    return met


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest codes of each query; ``upto`` counts rows up to there."""
    nearest = Window.partitionBy("qcode").orderBy("d", "low")
    top = found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k).drop("place")
    return top.withColumn("upto", F.sum("n").over(nearest))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "id", code: str = "code") -> DataFrame:
    """(query_id, rank from 1, neighbour_id, distance) of every query row."""
    base = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{code}`").cast("long").alias("code")).where(
        "id IS NOT NULL AND code IS NOT NULL").distinct()
    few = materialise(base.withColumn("nth", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(
        F.col("nth") <= k), "code-ids")
    codes = materialise(few.groupBy("code").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "codes")
    asked = materialise(queries.select(F.col(f"`{id_col}`").alias("query_id"), F.col(f"`{code}`").cast("long").alias("qcode"))
                        .where("query_id IS NOT NULL AND qcode IS NOT NULL").distinct(), "queries")
    parts = segments(codes.count())
    index = materialise(codes.select("code", "low", "n", F.explode(F.array(*[
        F.struct(F.lit(s).alias("seg"), _value(F.col("code"), o, w).alias("value")) for s, (o, w) in enumerate(parts)])).alias("p"))
        .select("code", "low", "n", F.col("p.seg").alias("seg"), F.col("p.value").alias("value")), "code-index")
    open_ = asked.select("qcode").distinct().withColumn("bound", F.lit(BITS))
    best, closed = None, []
    for radius in range(max(w for _, w in parts) + 1):
        probes = _probes(open_, parts, radius).alias("p")
        near = F.bit_count(F.col("qcode").bitwiseXOR(F.col("code")))
        # the probes are many more than the open queries that they are made from: not for a broadcast
        hits = probes.join(index.alias("x").hint("merge"), (F.col("p.seg") == F.col("x.seg")) & (F.col("p.value") == F.col("x.value"))
                           & (near <= F.col("bound")))
        hits = hits.where(_first_met(parts, radius)).select("qcode", "code", near.alias("d"), "low", "n")
        if best is not None:
            hits = hits.unionByName(best.select("qcode", "code", "d", "low", "n"))
        best = materialise(_best(hits, k), "nearest")
        covered = len(parts) * (radius + 1) - 1 if radius < min(w for _, w in parts) else BITS
        kth = materialise(open_.select("qcode").join(best.where(F.col("upto") >= k).groupBy("qcode").agg(
            F.min("d").alias("kth")), "qcode", "left"), "kth")
        done = (F.col("kth") <= covered) if covered < BITS else F.lit(True)
        done = F.coalesce(done, F.lit(False))
        closed.append(best.join(kth.where(done), "qcode", "left_semi"))
        open_ = materialise(kth.where(~done).select("qcode", F.coalesce("kth", F.lit(BITS)).alias("bound")), "open")
        if open_.isEmpty():
            break
        best = best.join(open_, "qcode", "left_semi")
    every = closed[0]
    for c in closed[1:]:
        every = every.unionByName(c)
    nearest = Window.partitionBy("qcode").orderBy("d", "id")
    ids = every.select("qcode", "code", "d").join(few.select("id", "code"), "code").withColumn(
        "rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return asked.join(ids, "qcode").select("query_id", "rank", F.col("id").alias("neighbour_id"), F.col("d").alias("distance"))
