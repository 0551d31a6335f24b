"""Connected components of a link table, by alternating star contraction.

Each round re-links every node's larger neighbours, then its smaller ones, to
the smallest neighbour it knows (the large-star and small-star steps of
Kiveris et al., 2014). Only per-node minima are aggregated (partial sums
before the shuffle) and joined back, so a hub with a large share of all links
is combined before it moves and its join is one that AQE can split. Rounds
grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.storage import materialise

MAX_ROUNDS = 60


def _relink(rows: DataFrame, only_larger: bool) -> DataFrame:
    """``rows`` (x, y): y is a neighbour of x. Pairs (neighbour, smallest)."""
    low = materialise(rows.groupBy("x").agg(F.min("y").alias("m"))
                      .select("x", F.least("x", "m").alias("m")), "star")
    out = rows.join(low, "x")
    if only_larger:
        out = out.where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("y").alias("u"), F.col("m").alias("v")).unionByName(
            low.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _digest(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another node; root is the
    smallest node of its component. Nodes are bigints. Loops, repeated links,
    nulls and an empty table are allowed (null ends are dropped)."""
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    links = materialise(links.where("u > v").distinct(), "links")
    seen = _digest(links)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            links.select(F.col("v").alias("x"), F.col("u").alias("y")))
        links = materialise(_relink(both, True), "large")
        links = materialise(_relink(links.select(F.col("u").alias("x"), F.col("v").alias("y")), False), "small")
        now = _digest(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
