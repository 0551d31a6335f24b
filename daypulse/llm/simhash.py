"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's 64-bit fingerprint takes, for each bit, the majority over the
XXH64 hashes of its word shingles. Two fingerprints link if they differ in at
most ``max_bits`` bits; the classes are the connected components.

Search (GPH, Qin et al., 2018). The bits are dealt into ``parts`` partitions
that keep correlated bits together. If a query's per-partition thresholds
t_1..t_m (-1: partition not probed) sum to ``max_bits - m + 1``, every
fingerprint within ``max_bits`` is within t_i in some partition i. Each
fingerprint gets its own thresholds by dynamic programming over estimated
candidate counts plus the number of probes; all are indexed under all
partition values, so every pair is found by both ends' probes and verified by
its full bit distance. Estimates steer cost only, never the result.

Equal fingerprints are one node before anything is compared. A partition
value with more than ``hot_rows`` distinct fingerprints is not compared
directly: its rows get one key for each pair of 4-bit blocks of the other
bits, with that pair blanked, so that a key's members differ in 8 known bits
at most (256 distinct fingerprints) while any two rows that differ by up to
two other bits still share a key. Links leave a task as a spanning forest, so
a group of copies makes as many links as members, not as many as pairs.

Defined results: a null or empty text, or one of white space only, has
fingerprint zero and links like any other; repeated rows keep one output row
each; null ids take part and the class id is the smallest non-null id (null if
there is none); columns of any name are kept as they are; a text of any length
is taken whole, at some 60 bytes a word; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.components import components
from daypulse.llm.storage import free_name, materialise, row_hash, share_code

BITS = 64
#: Distinct fingerprints that are sampled to measure which bits are correlated.
SAMPLE = 20_000
#: Leading bits of a partition whose value counts steer the thresholds.
HIST_BITS = 10
#: Candidate pairs that are held at once.
PAIRS = 2_000_000
_LANES = np.uint64(0x0101010101010101)


# --- fingerprints ---------------------------------------------------------

def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set (bit 0 first)."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        h = hashes[at:at + 65_536]
        for k in range(8):
            lanes = np.add.reduceat((h >> np.uint64(k)) & _LANES, np.arange(0, len(h), 255))
            total[k::8] += lanes.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    return total


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Unsigned fingerprint of UTF-8 bytes."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    norm = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    h64 = xxhash.xxh64_intdigest
    hashes = np.fromiter((h64(norm[i:j], 42) for i, j in zip(starts, stops)), np.uint64, n)
    return int(np.packbits(_bit_counts(hashes) * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", shingle: int = 3) -> DataFrame:
    """The ``keys`` columns of every row and ``fp``, the fingerprint's 64 bits
    as a signed bigint."""
    share_code(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = rows.drop("__text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index("__text")).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))],
                                             names=[*b.schema.names[:-1], "fp"])

    return rows.mapInArrow(run, schema)


# --- plan of the search ---------------------------------------------------

def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near-equal size; a group grows from its
    strongest pair by the bit with the largest mean correlation to it."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    with np.errstate(all="ignore"):
        c = np.abs(np.nan_to_num(np.corrcoef(bits, rowvar=False))) if len(bits) > 1 else np.zeros((BITS, BITS))
    np.fill_diagonal(c, -1)
    left, groups = list(range(BITS)), []
    for p in range(parts):
        size = len(left) // (parts - p)
        sub = c[np.ix_(left, left)]
        group = [left[int(i)] for i in np.unravel_index(int(sub.argmax()), sub.shape)][:size]
        group = list(dict.fromkeys(group)) or left[:1]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(rest[int(c[np.ix_(rest, group)].mean(1).argmax())])
        groups.append(group)
        left = [b for b in left if b not in group]
    return groups


def part_values(fps: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """(rows, parts): each fingerprint's value in each partition."""
    out = np.zeros((len(fps), len(groups)), np.uint64)
    for p, group in enumerate(groups):
        for k, bit in enumerate(group):
            out[:, p] |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


def masks(width: int, radius: int) -> np.ndarray:
    """All values of ``width`` bits with exactly ``radius`` bits set."""
    from itertools import combinations

    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)] or [0][:radius == 0], np.uint64)


def expected(hist: np.ndarray, widths: list[int], max_bits: int) -> list[np.ndarray]:
    """For each partition: [radius, leading bits] -> fingerprints expected
    within the radius, from the counts by leading bits, the rest taken as even."""
    from math import comb

    out = []
    for p, w in enumerate(widths):
        lead = min(HIST_BITS, w)
        h = hist[p][:1 << lead].astype(float)
        every = np.arange(1 << lead, dtype=np.uint64)
        exact = [sum(h[(every ^ m).astype(int)] for m in masks(lead, r)) + np.zeros(1 << lead) for r in range(max_bits + 1)]
        rest = [comb(w - lead, r) / 2 ** (w - lead) for r in range(max_bits + 1)]
        by = [sum(exact[a] * rest[r - a] for a in range(r + 1)) for r in range(max_bits + 1)]
        out.append(np.cumsum(by, axis=0))
    return out


def thresholds(values: np.ndarray, widths: list[int], counts: list[np.ndarray], max_bits: int) -> np.ndarray:
    """(rows, parts): each row's cheapest thresholds, by dynamic programming
    over the partitions; -1 leaves a partition out. They sum to
    ``max_bits - parts + 1``."""
    from math import comb

    n, m = values.shape
    goal = max_bits + 1  # sum of t + 1
    best = np.full((n, goal + 1), np.inf)
    best[:, 0] = 0
    picks = []
    for p in range(m):
        lead = (values[:, p] & np.uint64((1 << min(HIST_BITS, widths[p])) - 1)).astype(int)
        cost = [np.zeros(n)] + [sum(comb(widths[p], r) for r in range(t + 1)) + counts[p][t][lead]
                                for t in range(max_bits + 1)]
        trial = np.full((n, goal + 1, goal + 1), np.inf)  # [row, sum so far, t + 1]
        for s in range(goal + 1):
            for t in range(s + 1):
                if t < len(cost):
                    trial[:, s, t] = best[:, s - t] + cost[t]
        picks.append(trial.argmin(2))
        best = trial.min(2)
    out, s = np.zeros((n, m), np.int64), np.full(n, goal)
    for p in reversed(range(m)):
        t = picks[p][np.arange(n), s]
        out[:, p] = t - 1
        s = s - t
    return out


# --- probe and verify -----------------------------------------------------

def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) as links from each node to the smallest node that it
    reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    off = label != np.arange(len(nodes))
    return nodes[off], nodes[label[off]]


def _verified(fp: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray, max_bits: int) -> Iterator[tuple]:
    """Linked pairs between rows lo..mid (indexed) and mid..hi (probing) of
    each group, at most about PAIRS candidates at a time."""
    nd, npr = mid - lo, hi - mid
    start = 0
    todo = nd * npr
    while start < len(lo):
        stop = max(start + 1, int(np.searchsorted(np.cumsum(todo[start:]), PAIRS)) + start)
        if stop == start + 1 and todo[start] > PAIRS:  # one large group, in blocks
            x = fp[lo[start]:mid[start]]
            step = max(1, PAIRS // len(x))
            for s in range(int(mid[start]), int(hi[start]), step):
                q = fp[s:min(s + step, hi[start])]
                i, j = np.nonzero(np.bitwise_count(q[:, None] ^ x[None, :]) <= max_bits)
                yield q[i], x[j]
        else:
            k = slice(start, stop)
            per_query = np.repeat(nd[k], npr[k])
            q = np.repeat(np.concatenate([np.arange(m, h) for m, h in zip(mid[k], hi[k])]), per_query)
            first = np.repeat(np.repeat(lo[k], npr[k]), per_query)
            within = np.arange(len(q)) - np.repeat(np.cumsum(per_query) - per_query, per_query)
            a, b = fp[q], fp[first + within]
            ok = np.bitwise_count(a ^ b) <= max_bits
            yield a[ok], b[ok]
        start = stop


def _links(max_bits: int):
    """Worker: rows (key, probe, fp) sorted by key, indexed rows first."""

    def whole(key, probe, fp):
        change = np.flatnonzero(np.diff(key)) + 1
        lo, hi = np.concatenate([[0], change]), np.concatenate([change, [len(key)]])
        mid = hi - np.add.reduceat(probe, lo)
        some = (mid > lo) & (hi > mid) & ((hi - lo > 2) | (fp[lo] != fp[hi - 1]))  # not one that meets itself alone
        for a, b in _verified(fp, lo[some], mid[some], hi[some], max_bits):
            other = a != b
            if other.any():
                yield forest(a[other].view(np.int64), b[other].view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush(last: bool):
            nonlocal held
            key, probe, fp = (np.concatenate(c) for c in zip(*held))
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))
            held = [(key[cut:], probe[cut:], fp[cut:])] if cut < len(key) else []
            if cut:
                for u, v in whole(key[:cut], probe[:cut], fp[:cut]):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["a", "b"])

        for b in batches:
            if b.num_rows:
                held.append((np.asarray(b.column(0)), np.asarray(b.column(1)).astype(np.int64),
                             np.asarray(b.column(2)).view(np.uint64)))
                if sum(len(h[0]) for h in held) >= 200_000:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return run


def _probes(groups: list[list[int]], counts: list[np.ndarray], max_bits: int):
    """Worker: fingerprints to rows (key, probe, fp, rest): one indexed row
    for each partition, one probing row for each value within the threshold."""
    widths = [len(g) for g in groups]
    balls = {(w, r): masks(w, r) for w in set(widths) for r in range(max_bits + 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.asarray(batch.column(0)).view(np.uint64)
            for at in range(0, len(every), 5_000):
                fps = every[at:at + 5_000]
                values = part_values(fps, groups)
                limits = thresholds(values, widths, counts, max_bits)
                for p, w in enumerate(widths):
                    tag = np.int64(p) << np.int64(BITS - 3)
                    rows = [(values[:, p], 0, fps)]
                    for r in range(max_bits + 1):
                        q = limits[:, p] >= r
                        ball = balls[w, r]
                        rows.append(((values[q, p][:, None] ^ ball[None, :]).ravel(), 1, np.repeat(fps[q], len(ball))))
                    for v, probe, f in rows:
                        if len(v):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(v.astype(np.int64) ^ tag), pa.array(np.full(len(v), probe, np.int32)),
                                 pa.array(f.view(np.int64))], names=["key", "probe", "fp"])

    return run


def _refined(groups: list[list[int]]):
    """Worker: a hot key's rows under one key for each pair of blocks of the
    bits outside the key's partition, with that pair blanked."""
    from itertools import combinations

    plans = []
    for p in range(len(groups)):
        rest = [b for q, g in enumerate(groups) if q != p for b in g]
        blocks = [sum(1 << b for b in rest[k:k + 4]) for k in range(0, len(rest), 4)]
        keep = sum(1 << b for b in rest)
        plans.append([np.uint64(keep & ~(x | y)) for x, y in combinations(blocks, 2)] or [np.uint64(0)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, probe = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            fp = np.asarray(batch.column(2)).view(np.uint64)
            part = (key.view(np.uint64) >> np.uint64(BITS - 3)).astype(int)
            for p in np.unique(part):
                at = part == p
                for n, kept in enumerate(plans[p]):
                    x = (fp[at] & kept) ^ (key[at].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(n << 48)
                    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)  # chance collisions are verified away
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((x ^ (x >> np.uint64(29))).view(np.int64)), pa.array(probe[at]),
                         pa.array(fp[at].view(np.int64))], names=["key", "probe", "fp"])

    return run


def _histogram(groups: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(groups), 1 << HIST_BITS), np.int64)
        for batch in batches:
            values = part_values(np.asarray(batch.column(0)).view(np.uint64), groups)
            for p in range(len(groups)):
                total[p] += np.bincount((values[:, p] & np.uint64((1 << min(HIST_BITS, len(groups[p]))) - 1)).astype(int),
                                        minlength=1 << HIST_BITS)
        p, v = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(v), pa.array(total[p, v])], names=["p", "v", "n"])

    return run


def linked(fps: DataFrame, max_bits: int = 2, parts: int = 2, hot_rows: int = 20_000) -> DataFrame:
    """Links (a, b) that connect all of the distinct bigints ``fp`` that differ
    in at most ``max_bits`` bits, as spanning forests of the tasks' finds."""
    spark = fps.sparkSession
    share_code(spark)
    if not 1 <= parts <= max_bits + 1 or max_bits > 2:
        raise ValueError("1 <= parts <= max_bits + 1 and max_bits <= 2")
    share = max(1, fps.count() // SAMPLE)
    sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0).limit(2 * SAMPLE).toPandas()["fp"]
    groups = group_bits(sample.to_numpy(np.int64).view(np.uint64), parts)
    hist = np.zeros((parts, 1 << HIST_BITS), np.int64)
    cells = fps.mapInArrow(_histogram(groups), "p long, v long, n long").groupBy("p", "v").agg(F.sum("n").alias("n"))
    for r in cells.collect():  # at most parts * 2^HIST_BITS rows
        hist[r.p, r.v] = r.n
    counts = expected(hist, [len(g) for g in groups], max_bits)
    rows = fps.mapInArrow(_probes(groups, counts, max_bits), "key long, probe int, fp long")
    hot = materialise(fps.mapInArrow(_probes(groups, counts, max_bits), "key long, probe int, fp long").where("probe = 0")
                      .groupBy("key").count().where(F.col("count") > hot_rows).select("key"), "hot")
    if not hot.isEmpty():
        rows = rows.join(hot, "key", "left_anti").unionByName(
            rows.join(hot, "key", "left_semi").mapInArrow(_refined(groups), "key long, probe int, fp long"))
    rows = rows.repartition("key").sortWithinPartitions("key", "probe")
    return rows.mapInArrow(_links(max_bits), "a long, b long")


def simhash_classes(docs: DataFrame, keys: list[str], id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 2, parts: int = 2, hot_rows: int = 20_000) -> DataFrame:
    """The ``keys`` columns of every row (``id_col`` among them), ``fp``,
    ``root`` (the class's smallest fingerprint as a bigint) and
    ``component_id``, the smallest id of the row's class."""
    prints = materialise(fingerprints(docs, keys, text, shingle), "fingerprints")
    nodes = materialise(prints.groupBy("fp").agg(F.min(id_col).alias("low")), "fp-nodes")
    links = materialise(linked(nodes.select("fp"), max_bits, parts, hot_rows), "fp-links")
    roots = materialise(components(links), "fp-roots")
    nodes = materialise(nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")), "fp-rooted")
    lows = materialise(nodes.groupBy("root").agg(F.min("low").alias("component_id")), "fp-lows")
    nodes = materialise(nodes.join(lows, "root").select("fp", "root", "component_id"), "fp-classes")
    return prints.join(nodes, "fp", "left").select(*keys, "fp", "root", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class stays, whole: the one with the smallest id (ids
    before null; then the smallest row hash). Of rows that are equal in all
    columns one stays."""
    own, ident = free_name(docs, "__row"), free_name(docs, "__id")
    keyed = docs.withColumn(own, row_hash(docs))
    rows = materialise(simhash_classes(keyed.withColumn(ident, F.col(f"`{id_col}`")), [ident, own], ident, text, **options)
                       .select(F.col(ident).alias("__id"), F.col(own).alias("__row"), "root"), "dedup-rows")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull().alias("no_id"), "__id", "__row")).alias("s"))
    keep = materialise(rows.groupBy("__id", "__row").agg(F.count(F.lit(1)).alias("__n")).join(
        first.select(F.col("s.__id").alias("k_id"), F.col("s.__row").alias("k_row")),
        F.col("__id").eqNullSafe(F.col("k_id")) & (F.col("__row") == F.col("k_row")), "left_semi"), "dedup-keep")

    def kept(which):
        return keyed.join(which, keyed[f"`{id_col}`"].eqNullSafe(which["__id"]) & (keyed[own] == which["__row"]), "left_semi").drop(own)

    out = kept(keep.where("__n = 1"))
    if not keep.where("__n > 1").isEmpty():
        out = out.unionByName(kept(keep.where("__n > 1")).dropDuplicates())
    return out
