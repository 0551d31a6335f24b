"""URL verdicts: rules, and a character language-model ratio for the rest.

A rule (host and path prefix) decides the URLs that it fits; the longest wins.
The URLs that rules accept and those that they reject train one variable-order
Markov model each, over a reduced alphabet (letters, one digit class, ten
marks, one class for the rest): Witten-Bell interpolation from no context up to
``ORDER`` characters, P(c|x) = (n(xc) + t(x) P(c|x')) / (n(x) + t(x)), where x'
is x without its first character and t(x) counts the characters seen after x.
A URL's score is the mean over its characters of the difference of the models'
log-likelihoods, in millionths. Where neither model has seen xc it is that of c
after x' plus the difference of the logs of the escape weights t(x) / (n(x) +
t(x)), 0 for a context that a model has not seen; a character that neither has
seen is one of ``SYMBOLS`` for both. The threshold is the one of least error on a
fold of rule-judged URLs that took no part in training (``calibrate``). All of it
is DataFrame code.

The tables of n-grams and of contexts have at most 40 + 40^2 + 40^3 + 40^4 rows
whatever the input, so they are broadcast, each join with the n-grams of its
length only. URLs are scored once each, so a hot URL costs no more.

Defined results: a null URL has an empty host and path, no rule, no score and
the verdict ``allow``; without accepted or without rejected URLs every score is
0 and the verdict is ``allow`` where no rule decides; a score equal to the
threshold is ``allow``; a URL of any length counts whole; repeated rows keep a
row each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm.storage import materialise

#: (verdict, host, path): host itself or a parent domain.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
ORDER = 3
#: Thresholds are tried at multiples of STEP, up to STEPS of them either way.
STEP, STEPS = 10_000, 2_000
SYMBOLS = 40  # 26 letters, digit, 10 marks, other, begin, end
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COUNTS = ("na", "nr")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end;
    path: from there up to ``?``, ``#`` or the end. Both empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (verdict, rule), or null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def symbols(url: Column) -> Column:
    """The URL in the reduced alphabet, between begin and end marks."""
    low = F.translate(url, UPPER + "123456789", LOWER + "000000000")
    return F.concat(F.lit("^"), F.regexp_replace(low, r"[^a-z0/._?=&#:%-]", "*"), F.lit("$"))


def _positions(urls: DataFrame, *keep: str) -> DataFrame:
    """One row for each character but the first: it is the last of ``g3``,
    behind the characters before it."""
    at = urls.select(*keep, "t", F.explode(F.sequence(F.lit(2), F.length("t"))).alias("i"))
    return at.select(*keep, F.expr(f"substring(t, greatest(1, i - {ORDER}), least(i, {ORDER + 1}))").alias("g"))


def train(urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, w): for each n-gram seen in an accepted or rejected URL, the
    log-likelihood difference of its last character; and (x, e): for each
    context that of the models' escape weights; both in millionths.
    ``urls``: t, label (allow or block), n (copies)."""
    grams = _positions(urls, "label", "n").select("label", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("g")), lambda k: F.right("g", k))).alias("g"))
    seen = materialise(grams.groupBy("g").agg(
        *[F.coalesce(F.sum(F.when(F.col("label") == v, F.col("n"))), F.lit(0)).alias(c)
          for v, c in zip(("allow", "block"), _COUNTS)]), "url-ngrams")
    after = materialise(seen.groupBy(F.expr("substring(g, 1, length(g) - 1)").alias("x")).agg(
        *[F.sum(c).cast("double").alias(c) for c in _COUNTS],
        *[F.sum((F.col(c) > 0).cast("int")).cast("double").alias("t" + c[1]) for c in _COUNTS]), "url-contexts")
    lower, found = None, []
    for k in range(ORDER + 1):
        own = seen.where(F.length("g") == k + 1).withColumn("x", F.expr("substring(g, 1, length(g) - 1)"))
        ctx = after.select("x", *[F.col(c).alias("c" + c) for c in _COUNTS], "ta", "tr")
        own = own.join(F.broadcast(ctx), "x")
        if lower is None:
            own = own.withColumns({"qa": F.lit(1.0 / SYMBOLS), "qr": F.lit(1.0 / SYMBOLS)})
        else:
            own = own.withColumn("y", F.expr("substring(g, 2)")).join(F.broadcast(lower.select(
                F.col("g").alias("y"), F.col("pa").alias("qa"), F.col("pr").alias("qr"))), "y")
        for s in "ar":
            n, t, q = F.col(f"cn{s}"), F.col(f"t{s}"), F.col(f"q{s}")
            own = own.withColumn(f"p{s}", F.when(n + t > 0, (F.col(f"n{s}") + t * q) / (n + t)).otherwise(q))
        lower = materialise(own.select("g", "pa", "pr"), "url-order")
        found.append(lower)
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    weights = materialise(every.select("g", F.round((F.log("pa") - F.log("pr")) * 1e6).cast("long").alias("w")), "url-weights")
    a, r = (F.when(F.col(f"n{s}") + F.col(f"t{s}") > 0, F.log(F.col(f"t{s}") / (F.col(f"n{s}") + F.col(f"t{s}")))).otherwise(0.0)
            for s in "ar")
    return weights, materialise(after.select("x", F.round((a - r) * 1e6).cast("long").alias("e")), "url-escapes")


def score(urls: DataFrame, weights: DataFrame, escapes: DataFrame) -> DataFrame:
    """(url, score) of distinct URLs: mean log-likelihood difference over the
    characters, floored."""
    rows = _positions(urls, "url")
    total = None
    for k in range(1, ORDER + 2):  # the character after k - 1 others
        own = weights.where(F.length("g") == k).select(F.col("g").alias(f"g{k}"), F.col("w").alias(f"w{k}"))
        rows = rows.join(F.broadcast(own), (F.right("g", F.lit(k)) == F.col(f"g{k}")) & (F.length("g") >= k), "left")
        before = F.expr(f"substring(g, length(g) - {k - 1}, {k - 1})")
        ctx = escapes.where(F.length("x") == k - 1).select(F.col("x").alias(f"x{k}"), F.col("e").alias(f"e{k}"))
        rows = rows.join(F.broadcast(ctx), (before == F.col(f"x{k}")) & (F.length("g") >= k), "left")
        unseen = F.coalesce(f"e{k}", F.lit(0)) if total is None else F.coalesce(f"e{k}", F.lit(0)) + total
        total = F.coalesce(f"w{k}", unseen)
    return rows.groupBy("url").agg(F.floor(F.sum(total).cast("double") / F.count(F.lit(1))).cast("long").alias("score"))


def calibrate(scored: DataFrame) -> DataFrame:
    """One row: ``limit``, the threshold of least error on the rule-judged URLs
    of the fold, in steps of ``STEP``, and ``error``, the mean of the shares of
    accepted URLs below it and of rejected URLs that are not. Of equal ones
    the lowest, in the middle of the gap below it. No row without both classes."""
    step = F.greatest(F.lit(-STEPS), F.least(F.lit(STEPS), F.floor(F.col("score") / F.lit(float(STEP)))))
    bins = scored.where("fold AND label IS NOT NULL AND score IS NOT NULL").groupBy(step.cast("long").alias("b")).agg(
        *[F.coalesce(F.sum(F.when(F.col("label") == v, F.col("n"))), F.lit(0)).cast("decimal(20,0)").alias(v) for v in ("allow", "block")])
    below, every = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()  # 2 * STEPS + 1 rows at most
    sums = bins.select("b", F.lag("b").over(Window.orderBy("b")).alias("last"), *[x for v in ("allow", "block") for x in (
        F.coalesce(F.sum(v).over(below), F.lit(0)).cast("decimal(18,0)").alias("before_" + v),
        F.sum(v).over(every).cast("decimal(18,0)").alias("all_" + v))])
    cost = F.col("before_allow") * F.col("all_block") + (F.col("all_block") - F.col("before_block")) * F.col("all_allow")
    best = sums.where("all_allow > 0 AND all_block > 0").agg(F.min(F.struct(
        cost.alias("cost"), "b", F.coalesce(F.col("last") + 1, F.col("b")).alias("low"), (F.col("all_allow") * F.col("all_block")).alias("size"))).alias("s"))
    return best.where("s IS NOT NULL").select((F.floor((F.col("s.low") + F.col("s.b")) / 2) * STEP).cast("long").alias("limit"),
                                              (F.col("s.cost") / F.col("s.size") / 2).cast("double").alias("error"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The id, host, path, rule (or null), verdict (allow or block) and score
    of every row."""
    rows = pages.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{url_col}`").cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    urls = rows.where("url IS NOT NULL").groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    urls = urls.withColumns({"host": host, "path": path}).withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    urls = materialise(urls.select("url", "n", "host", "path", F.col("hit.verdict").alias("label"), F.col("hit.rule").alias("rule"),
                                   symbols(F.col("url")).alias("t"), F.substring(F.md5("url"), 1, 1).isin("0", "1", "2").alias("fold")), "urls")
    weights, escapes = train(urls.where("label IS NOT NULL AND NOT fold"))
    scored = materialise(urls.join(score(urls, weights, escapes), "url").select("url", "host", "path", "label", "rule", "n", "fold",
                                                                                "score"), "url-scores")
    trained = {r["label"] for r in urls.where("label IS NOT NULL AND NOT fold").select("label").distinct().collect()}
    both = {"allow", "block"} <= trained  # one class alone says nothing about the other
    found = calibrate(scored).first() if both else None
    limit = found["limit"] if found else 0
    value = F.col("score") if both else F.when(F.col("score").isNotNull(), F.lit(0).cast("long"))
    out = rows.join(scored, "url", "left")
    return out.select(id_col, F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule",
                      F.coalesce("label", F.when(value < limit, "block").otherwise("allow")).alias("verdict"),
                      value.alias("score"))
