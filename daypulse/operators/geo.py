"""IP -> location, an inclusive range (interval) lookup.

Catalyst has no range join: ``ip BETWEEN start AND end`` alone becomes a
nested-loop join. Two forms are provided.

* ``bucketed`` (default, any size): every range is exploded into the
  ``2**bucket_bits``-address blocks it touches, IPs get their block number,
  and the join is an equi-join on the block plus a residual ``BETWEEN``.
  Each IP meets only the few ranges of its own block, so the work is linear
  in (#IPs + #range blocks); nothing has to fit in memory, and AQE still
  broadcasts the range side when its *measured* size is small.
* ``broadcast``: broadcast nested loop over the ranges, for small range
  tables; the number of ranges is checked first (``MAX_BROADCAST_RANGES``).

Both work on *distinct* IPs first (a hot IP costs one lookup) and join the
answer back. Overlapping ranges give one answer: the range with the
greatest start (then the narrowest). No match: ``"unknown"``.

* ``disjoint`` (for facts): the ranges are cut at each other's ends first, so
  that every address lies in one piece at most (:func:`disjoint_ranges`, work on
  the dimension alone). The facts then join the pieces themselves: no distinct
  IPs, no second read of the rows, no join back, and no shuffle of the facts at
  all where AQE finds the pieces small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.functions.net import ip_to_long

UNKNOWN = "unknown"
#: Fixed value: the largest IPv4 number. A range beyond it is no range of addresses.
MAX_IPV4 = 4_294_967_295
#: The ``broadcast`` form takes so many ranges at most (about 100 bytes each).
MAX_BROADCAST_RANGES = 100_000


def valid_range():
    """Whether ``start_ip``..``end_ip`` is a range of IPv4 numbers. Others are
    dropped from a lookup: exploded into blocks, one wild end bound would make
    rows without limit."""
    return F.coalesce((F.col("start_ip") >= 0) & (F.col("start_ip") <= F.col("end_ip"))
                      & (F.col("end_ip") <= MAX_IPV4), F.lit(False))


def location_label(ranges: DataFrame) -> DataFrame:
    """``country || ' ' || city`` (null parts are skipped)."""
    return ranges.select("start_ip", "end_ip",
                         F.concat_ws(" ", "country", "local_city").alias("_loc"))


def _best(cands: DataFrame, keys) -> DataFrame:
    # Greatest start, then narrowest range, then label: one struct max.
    hit = F.when(F.col("_loc").isNotNull(),
                 F.struct(F.col("start_ip"), (-F.col("end_ip")).alias("neg_end"), F.col("_loc")))
    return (cands.groupBy(*keys)
            .agg(F.coalesce(F.max(hit)["_loc"], F.lit(UNKNOWN)).alias("_location")))


def _candidates(probes: DataFrame, ranges: DataFrame, strategy: str, bucket_bits: int) -> DataFrame:
    """``probes`` (with ``_ipn``) left-joined with every range holding it."""
    labelled = location_label(ranges.filter(valid_range()))
    inside = (F.col("_ipn") >= F.col("start_ip")) & (F.col("_ipn") <= F.col("end_ip"))
    if strategy == "broadcast":
        if ranges.limit(MAX_BROADCAST_RANGES + 1).count() > MAX_BROADCAST_RANGES:
            raise ValueError(f"more than {MAX_BROADCAST_RANGES} ranges: use the bucketed strategy")
        return probes.join(F.broadcast(labelled), inside, "left")
    if strategy == "bucketed":
        blocks = labelled.withColumn(
            "_bucket", F.explode(F.sequence(F.shiftright("start_ip", bucket_bits),
                                            F.shiftright("end_ip", bucket_bits))))
        keyed = probes.withColumn("_bucket", F.shiftright("_ipn", bucket_bits))
        return (keyed.join(blocks, (keyed["_bucket"] == blocks["_bucket"]) & inside, "left")
                .drop(blocks["_bucket"]))
    raise ValueError(f"unknown strategy {strategy!r}")


def locate_ips(ips: DataFrame, ranges: DataFrame, strategy: str = "bucketed",
               bucket_bits: int = 16) -> DataFrame:
    """Distinct IP strings -> (``_ip``, ``_ipn``, ``_location``)."""
    keys = ips.select(F.col("_ip")).distinct().withColumn("_ipn", ip_to_long("_ip"))
    return _best(_candidates(keys, ranges, strategy, bucket_bits), ["_ip", "_ipn"])


def locate_numbers(numbers: DataFrame, ranges: DataFrame, strategy: str = "bucketed",
                   bucket_bits: int = 16) -> DataFrame:
    """Distinct IPv4 numbers (column ``_ipn``) -> (``_ipn``, ``_location``)."""
    keys = numbers.select("_ipn").distinct()
    return _best(_candidates(keys, ranges, strategy, bucket_bits), ["_ipn"])


def disjoint_ranges(ranges: DataFrame, bucket_bits: int = 16) -> DataFrame:
    """Pieces (_bucket, _lo, _hi, _loc) that do not overlap: within each block
    the ranges' starts, the addresses behind their ends and the block's start
    are the only places where the answer can change; each is looked up once."""
    valid = ranges.filter(valid_range())
    block = F.explode(F.sequence(F.shiftright("start_ip", bucket_bits), F.shiftright("end_ip", bucket_bits)))
    first = valid.select(block.alias("_bucket")).select(F.call_function("shiftleft", F.col("_bucket"), F.lit(bucket_bits)).alias("_ipn"))
    points = first.unionByName(valid.select(F.col("start_ip").alias("_ipn"))).unionByName(
        valid.select((F.col("end_ip") + 1).alias("_ipn")))
    named = locate_numbers(points, ranges, "bucketed", bucket_bits).withColumn("_bucket", F.shiftright("_ipn", bucket_bits))
    after = F.lead("_ipn").over(Window.partitionBy("_bucket").orderBy("_ipn"))  # the points of one block
    last = F.call_function("shiftleft", F.col("_bucket") + 1, F.lit(bucket_bits))
    pieces = named.select("_bucket", F.col("_ipn").alias("_lo"), (F.coalesce(after, last) - 1).alias("_hi"), F.col("_location").alias("_loc"))
    return pieces.where(F.col("_loc") != UNKNOWN)


def _in_pieces(facts: DataFrame, ranges: DataFrame, ip_col: str, out_col: str, bucket_bits: int) -> DataFrame:
    keyed = facts.withColumn("_ipn", ip_to_long(ip_col)).withColumn("_b", F.shiftright("_ipn", bucket_bits))
    pieces = disjoint_ranges(ranges, bucket_bits)
    held = (F.col("_b") == F.col("_bucket")) & (F.col("_ipn") >= F.col("_lo")) & (F.col("_ipn") <= F.col("_hi"))
    return keyed.join(pieces, held, "left").withColumn(out_col, F.coalesce("_loc", F.lit(UNKNOWN))).select(*facts.columns, out_col)


def with_location(facts: DataFrame, ranges: DataFrame, ip_col: str = "ip",
                  out_col: str = "loc", strategy: str = "bucketed",
                  bucket_bits: int = 16, keys: DataFrame | None = None) -> DataFrame:
    """Add ``out_col`` (location label) to every fact row by its IP.

    The location depends only on the IP's number (F8; malformed or null IPs
    are 0), so the lookup table is keyed by that ``bigint``: the join-back
    hashes and sorts a long instead of a string and needs no null-safe
    equality. It is built from the distinct numbers of ``keys[ip_col]``
    (default: the facts); passing a cheap superset — e.g. the raw rows the
    facts were aggregated from — avoids computing the facts twice. With
    ``strategy="disjoint"`` the facts join the pieces directly, ``keys`` is not
    needed."""
    if strategy == "disjoint":
        return _in_pieces(facts, ranges, ip_col, out_col, bucket_bits)
    source = facts if keys is None else keys
    located = locate_numbers(source.select(ip_to_long(ip_col).alias("_ipn")), ranges,
                             strategy, bucket_bits)
    joined = facts.withColumn("_ipn", ip_to_long(ip_col)).join(located, "_ipn", "left")
    return joined.withColumn(out_col, F.col("_location")).drop("_ipn", "_location")
