"""Temperature mixing of sources, realised as budgeted block permutations.

Source s holds a share p_s of the tokens and is drawn with weight p_s^a,
normalised. The exponent a in [0, 1] is found by bisection: the largest one
whose weights have at least ``entropy`` times the largest possible entropy;
then, where a source would repeat more than ``max_repetition`` times, the
smallest larger one that meets that limit. (a = 1, the natural shares, repeats
every source ``budget / tokens`` times, so a limit below that lowers the
budget to ``max_repetition * tokens``.)

A source's budget is realised in epochs. Its documents lie in ``BLOCKS``
blocks by a hash of their id; an epoch is a keyed permutation of the blocks,
with the documents of a block in the order of a keyed hash. Whole epochs take
every document once; the last, partial one takes the documents in its order
until the next would exceed the budget. Its cut is found by sums over 4,096
intervals of the order key, then over 4,096 parts of the interval that holds
the cut, and so on: small tables of equal size for every source, whatever its
share of the rows.

Defined results: a null source is a source of its own; documents without
tokens (null or empty text) are drawn with their epoch and use no budget (a
source of such documents alone is drawn once); a
corpus without tokens is drawn once, whole; rows with equal ids lie side by
side and are cut together only if they are equal in all columns; an empty
table gives an empty table; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm.storage import free_name, materialise, row_hash

BITS = 12
BLOCKS = 1 << BITS
LEVELS = 5
#: Depth of the bisection tree whose inner points one pass evaluates.
DEPTH = 4


def n_tokens(text: Column) -> Column:
    """Words between white space, as a stand-in for tokens."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


@dataclass
class Mix:
    exponent: float
    budget: int
    plan: DataFrame  # source_key, weight, target (tokens), epochs (whole ones), cut (the last order key of the partial one)


def _entropy_and_top(shares: DataFrame, exponents: list[float], budget: float) -> list[tuple[float, float]]:
    """For each exponent: the entropy over the largest possible one, and the
    largest number of repetitions; one pass over the sources."""
    z = shares.agg(*[F.sum(F.pow("p", F.lit(a))).alias(f"z{i}") for i, a in enumerate(exponents)],
                   F.count(F.lit(1)).alias("k")).first()
    weights = [F.pow("p", F.lit(a)) / F.lit(float(z[f"z{i}"])) for i, a in enumerate(exponents)]
    r = shares.agg(*[F.sum(-w * F.log(w)).alias(f"h{i}") for i, w in enumerate(weights)],
                   *[F.max(w * budget / F.col("tokens")).alias(f"r{i}") for i, w in enumerate(weights)]).first()
    import math

    top = math.log(z["k"]) if z["k"] > 1 else 1.0
    return [(r[f"h{i}"] / top if z["k"] > 1 else 1.0, r[f"r{i}"]) for i in range(len(exponents))]


def bisect(test, steps: int = 28) -> tuple[float, float]:
    """(lo, hi) around the point of [0, 1] where ``test`` turns from true to
    false. ``test`` takes a list of points: those of ``DEPTH`` steps ahead."""
    lo, hi = 0.0, 1.0
    while steps > 0:
        n = 1 << DEPTH
        points = [lo + (hi - lo) * k / n for k in range(1, n)]
        known = dict(zip(range(1, n), test(points)))
        a, b = 0, n
        for _ in range(DEPTH):
            mid = (a + b) // 2
            a, b = (mid, b) if known[mid] else (a, mid)
        lo, hi = lo + (hi - lo) * a / n, lo + (hi - lo) * b / n
        steps -= DEPTH
    return lo, hi


def exponent(shares: DataFrame, budget: float, entropy: float, max_repetition: float) -> float:
    """The temperature exponent for a table (p, tokens) with one row a source."""
    def measure(points):
        return _entropy_and_top(shares, points, budget)

    (h0, _), (h1, _) = measure([0.0, 1.0])
    a = 1.0 if h1 >= entropy else bisect(lambda x: [h >= entropy for h, _ in measure(x)])[0]
    if measure([a])[0][1] <= max_repetition:
        return a
    return bisect(lambda x: [r > max_repetition for _, r in measure(x)])[1]


def _keys(docs: DataFrame, source: str, id_col: str, seed: int) -> tuple[Column, Column]:
    """(block, rest): the document's block, and its place inside a block."""
    ident = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    return (F.pmod(F.xxhash64(F.lit(seed), ident), F.lit(BLOCKS)),
            F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), ident, F.col("__row")), 64 - BITS * (LEVELS - 1)))


def order_key(source_key: Column, block: Column, rest: Column, epoch: Column, seed: int) -> Column:
    """Place in an epoch's order, 60 bits: the block's place in the epoch's
    keyed permutation (odd multiplier, offset), then the document's."""
    keyed = F.xxhash64(F.lit(seed + 2), source_key, epoch)
    odd = F.pmod(keyed, F.lit(BLOCKS >> 1)) * 2 + 1
    add = F.pmod(F.shiftrightunsigned(keyed, 32), F.lit(BLOCKS))
    return F.pmod(block * odd + add, F.lit(BLOCKS)) * F.lit(1 << (BITS * (LEVELS - 1))) + rest


def plan_mix(rows: DataFrame, budget: int | None, entropy: float, max_repetition: float, seed: int) -> Mix | None:
    """``rows``: source_key, tokens, block, rest, one row for each document."""
    shares = materialise(rows.groupBy("source_key").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    total = shares.agg(F.sum("tokens")).first()[0]
    if not total:
        return None
    budget = int(min(budget or total, max_repetition * total))
    live = materialise(shares.where("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(total))), "mix-shares")
    a = exponent(live, float(budget), entropy, max_repetition)
    z = live.agg(F.sum(F.pow("p", F.lit(a)))).first()[0]
    plan = shares.withColumn("weight", F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a)) / F.lit(z))
                             .otherwise(F.lit(0.0)))
    plan = plan.withColumn("target", F.floor(F.col("weight") * (budget * (1 + 1e-12)) + 1e-6).cast("long"))
    plan = plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens")).cast("int"))
                           .otherwise(F.lit(0)))
    plan = materialise(plan.withColumn("left", F.when(F.col("tokens") > 0, F.col("target") - F.col("epochs") * F.col("tokens"))
                                       .otherwise(F.lit(0))).withColumn("lo", F.lit(0).cast("long")), "mix-plan")
    # the partial epoch: narrow [lo, lo + width) around the first document that does not fit
    for level in range(LEVELS):
        width = 1 << (BITS * (LEVELS - 1 - level))
        key = order_key(F.col("source_key"), F.col("block"), F.col("rest"), F.col("epochs"), seed)
        inside = rows.join(plan.select("source_key", "epochs", "lo"), "source_key").withColumn("key", key).where(
            (F.col("key") >= F.col("lo")) & (F.col("key") < F.col("lo") + F.lit(width << BITS)))
        cells = materialise(inside.groupBy("source_key", ((F.col("key") - F.col("lo")) / width).cast("int").alias("cell")).agg(
            F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")), "mix-cells")
        run = cells.join(plan.select("source_key", "left"), "source_key").withColumn(
            "done", F.sum("t").over(Window.partitionBy("source_key").orderBy("cell")))
        first = run.where("done > left").groupBy("source_key").agg(F.min("cell").alias("cell"))
        before = run.join(first.withColumnRenamed("cell", "stop"), "source_key", "left")
        step = materialise(before.groupBy("source_key").agg(
            F.coalesce(F.max("stop"), F.lit(BLOCKS)).alias("cell"),
            F.coalesce(F.sum(F.when(F.col("stop").isNull() | (F.col("cell") < F.col("stop")), F.col("t"))), F.lit(0)).alias("spent"),
            F.coalesce(F.max(F.when(F.col("cell") == F.col("stop"), F.col("n"))), F.lit(0)).alias("open")), "mix-step")
        plan = materialise(plan.join(step, "source_key", "left").select(
            "source_key", "tokens", "weight", "target", "epochs",
            (F.col("left") - F.coalesce("spent", F.lit(0))).alias("left"),
            (F.col("lo") + F.coalesce("cell", F.lit(0)).cast("long") * F.lit(width)).alias("lo")), "mix-plan")
        if step.agg(F.max("open")).first()[0] in (0, 1, None):
            break
    return Mix(a, budget, plan.select("source_key", "weight", "target", "epochs", F.col("lo").alias("cut")))


def mix(docs: DataFrame, budget: int | None = None, entropy: float = 0.95, max_repetition: float = 4.0, seed: int = 17,
        source: str = "source", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` as drawn: one row for each epoch that takes it,
    with mix_epoch (from 0), mix_block (the block's place in the epoch) and
    mix_key (the place in the epoch's order). ``budget``: tokens in all, by
    default as many as the corpus has. A column of ``docs`` keeps its name and
    values; where it has one of these names, the operator's own takes the first
    free one of mix_epoch_2, mix_epoch_3, ..."""
    source_key = F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("null"))
    names = {n: free_name(docs, n) for n in ("mix_epoch", "mix_block", "mix_key")}
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), source_key.alias("__source_key"),
                        F.col(f"`{id_col}`").alias(id_col), row_hash(docs).alias("__row"), n_tokens(F.col(f"`{text}`")).alias("__tokens"))
    block, rest = _keys(whole, source, id_col, seed)
    keyed = whole.withColumns({"__block": block, "__rest": rest})
    rows = materialise(keyed.select(F.col("__source_key").alias("source_key"), F.col("__tokens").alias("tokens"),
                                    F.col("__block").alias("block"), F.col("__rest").alias("rest")), "mix-rows")
    made = plan_mix(rows, budget, entropy, max_repetition, seed)
    if made is None:
        out = keyed.withColumns({"__epochs": F.lit(1), "__cut": F.lit(0).cast("long")})
    else:
        plan = materialise(made.plan.select(F.col("source_key").alias("__source_key"), F.col("epochs").alias("__epochs"),
                                            F.col("cut").alias("__cut")), "mix-plan")
        out = keyed.join(plan, "__source_key")
    in_part = order_key(F.col("__source_key"), F.col("__block"), F.col("__rest"), F.col("__epochs"), seed) < F.col("__cut")
    copies = F.col("__epochs") + F.when(in_part, 1).otherwise(0)
    out = out.withColumn("mix_epoch", F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(
        F.array().cast("array<int>"))))
    out = out.withColumn("mix_key", order_key(F.col("__source_key"), F.col("__block"), F.col("__rest"), F.col("mix_epoch"), seed))
    out = out.withColumn("mix_block", F.shiftright("mix_key", BITS * (LEVELS - 1)).cast("int"))
    return out.select("__doc.*", *[F.col(n).alias(own) for n, own in names.items()])
