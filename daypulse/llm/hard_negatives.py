"""Hard negatives by segment summary filtering.

An anchor's positives are its best rows of the same label; its hard negatives
for a positive are the best rows of other labels whose score lies within given
shares of the positive's score. A score is the integer inner product of vectors
whose components x became floor(scale * x).

Bounds. A vector is cut into segments of w components; each keeps its mean m and
deviation s. Over a segment the inner product of x and y is w m(x) m(y) plus the
product of what is left around the means, which by Cauchy-Schwarz is at most
w s(x) s(y) either way. The sums over the segments bound a score from above and
below. Rows are tried against a block of anchors with coarse segments first, the
rows that may still count for one of them with finer segments, and what is left
is scored exactly. A row is out for an anchor if its upper bound is below what
the anchor has already found (or below the least useful score), or its lower
bound is above the largest useful score.

Distribution. Rows are range partitioned by label, a code of their coarse means,
and id, so a group of rows has few labels and like vectors; no key is held by
more than one id. Anchors travel in blocks to the groups that share a label with
them (positives), then to all groups (negatives: the stated query set against
all rows, in blocks). A task holds one group and one block of anchors at a time;
each returns at most ``positives``, or ``negatives`` a positive, for each anchor.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part; equal rows count once; rows with the anchor's id are not
its positives; ties go to the smaller id; shorter vectors are filled up with
zeros; an anchor without positives, or a positive without negatives, gives no
row; scores must stay below 2^62, else a ValueError names the component; empty
tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm.storage import materialise, share_code

#: Rows of a group at most aimed at, anchors of a block, and rows that are bounded at once.
GROUP, BLOCK, AT_ONCE = 16_384, 512, 2_048
#: Components of a segment, coarse to fine; the first also orders the rows.
WIDTHS = (16, 8, 4)
_LARGEST = 1 << 27


def usable(id_: Column, label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return id_.isNotNull() & label.isNotNull() & vector.isNotNull() & finite


def summary(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of the rows of x."""
    n = -(-x.shape[1] // width) * width
    parts = np.pad(x, ((0, 0), (0, n - x.shape[1]))).reshape(len(x), -1, width)
    return parts.mean(2), parts.std(2)


def bounds(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores of rows of a and b, from their summaries."""
    middle, around = width * (a[0] @ b[0].T), width * (a[1] @ b[1].T)
    slack = 1e-9 * (np.abs(middle).max(initial=0) + around.max(initial=0)) + 1e-6  # for rounding in the sums
    return middle - around - slack, middle + around + slack


class Vectors:
    """Integer vectors with ids and labels, and their summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.labels, self.x = ids, labels, x
        self.exact = x.astype(float) if x.shape[1] * int(np.abs(x).max(initial=0)) ** 2 < 1 << 53 else x
        self.summaries = [summary(x.astype(float), w) for w in WIDTHS]

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, at: np.ndarray) -> Vectors:
        out = object.__new__(Vectors)
        out.ids, out.labels, out.x, out.exact = self.ids[at], self.labels[at], self.x[at], self.exact[at]
        out.summaries = [(m[at], s[at]) for m, s in self.summaries]
        return out


def score(a: Vectors, b: Vectors) -> np.ndarray:
    """Exact scores: in doubles where they hold every sum, else in integers."""
    if a.exact.dtype == float and b.exact.dtype == float:
        top = a.x.shape[1] * int(np.abs(a.x).max(initial=0)) * int(np.abs(b.x).max(initial=0))
        if top < 1 << 53:
            return (a.exact @ b.exact.T).astype(np.int64)
    return a.x @ b.x.T


def candidates(a: Vectors, rows: Vectors, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of rows, mask): rows that may score from least to most for an
    anchor that they are allowed for, by ever finer segments."""
    at, mask = np.arange(len(rows)), allowed
    for level, width in enumerate(WIDTHS):
        low, high = bounds(a.summaries[level], tuple(s[at] for s in rows.summaries[level]), width)
        mask = mask & (high >= least[:, None]) & (low <= most[:, None])
        some = mask.any(0)
        at, mask = at[some], mask[:, some]
        if not len(at):
            break
    return at, mask


class Best:
    """The k best rows found for each of n searches: larger scores, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.found = k, [[] for _ in range(n)]

    def least(self, i: int, floor_: float) -> float:
        """A score that a further row must reach to count."""
        return max(floor_, -self.found[i][-1][0]) if len(self.found[i]) == self.k else floor_

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            kth = np.partition(scores, -self.k)[-self.k]
            keep = scores >= kth
            scores, ids = scores[keep], ids[keep]
            if len(scores) > self.k:
                keep = np.lexsort((ids, -scores))[:self.k]
                scores, ids = scores[keep], ids[keep]
        if len(scores):
            self.found[i] = sorted(self.found[i] + list(zip((-scores).tolist(), ids.tolist())))[:self.k]


def search_positives(a: Vectors, rows: Vectors, k: int) -> Best:
    best = Best(len(a), k)
    for at in range(0, len(rows), AT_ONCE):
        part = rows.take(np.arange(at, min(at + AT_ONCE, len(rows))))
        allowed = (a.labels[:, None] == part.labels) & (a.ids[:, None] != part.ids)
        least = np.array([best.least(i, -np.inf) for i in range(len(a))])
        at_, mask = candidates(a, part, allowed, least, np.full(len(a), np.inf))
        if len(at_):
            found = score(a, part.take(at_))
            for i in np.flatnonzero(mask.any(1)):
                best.add(i, found[i, mask[i]], part.ids[at_[mask[i]]])
    return best


def search_negatives(a: Vectors, owner: np.ndarray, lowest: np.ndarray, highest: np.ndarray, rows: Vectors, k: int) -> Best:
    """For each search (of anchor owner, with its least and largest score)."""
    best = Best(len(owner), k)
    by_anchor = [np.flatnonzero(owner == i) for i in range(len(a))]
    most = np.array([highest[s].max(initial=-np.inf) if len(s) else -np.inf for s in by_anchor])
    for at in range(0, len(rows), AT_ONCE):
        part = rows.take(np.arange(at, min(at + AT_ONCE, len(rows))))
        least = np.array([min((best.least(j, lowest[j]) for j in s), default=np.inf) for s in by_anchor])
        at_, mask = candidates(a, part, a.labels[:, None] != part.labels, least, most)
        if not len(at_):
            continue
        found = score(a, part.take(at_))
        for i in np.flatnonzero(mask.any(1)):
            own, ids = found[i, mask[i]], part.ids[at_[mask[i]]]
            for j in by_anchor[i]:
                fits = (own >= best.least(j, lowest[j])) & (own <= highest[j])
                if fits.any():
                    best.add(j, own[fits], ids[fits])
    return best


_BLOCK = "part int, nth int, ids array<long>, labels array<long>, dims int, x binary"


def _vectors(block: dict) -> Vectors:
    x = np.frombuffer(block["x"], "<i8").reshape(len(block["ids"]), block["dims"])
    return Vectors(np.array(block["ids"], np.int64), np.array(block["labels"], np.int64), x)


def _joined(blocks: list[dict]) -> Vectors:
    """The blocks as one; shorter vectors are filled up."""
    dims = max(b["dims"] for b in blocks)
    parts = [_vectors(b) for b in blocks]
    return Vectors(np.concatenate([p.ids for p in parts]), np.concatenate([p.labels for p in parts]),
                   np.concatenate([np.pad(p.x, ((0, 0), (0, dims - p.x.shape[1]))) for p in parts]))


def _aligned(a: Vectors, dims: int) -> Vectors:
    return a if a.x.shape[1] >= dims else Vectors(a.ids, a.labels, np.pad(a.x, ((0, 0), (0, dims - a.x.shape[1]))))


def _coded(rows: DataFrame, scale: float) -> DataFrame:
    """(id, label, code, x): integer vectors as bytes, equal rows once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_048):
                b = batch.slice(at, 2_048)
                lists = b.column(2)
                flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(float))
                if np.abs(flat).max(initial=0) > _LARGEST:
                    raise ValueError(f"component {np.abs(flat).max()} is over {_LARGEST}: scores might not fit 62 bits")
                ends = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
                x = flat.astype("<i8")
                code, data = [], []
                for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    v = x[i:j]
                    means = [v[p:p + WIDTHS[0]].sum() for p in range(0, min(len(v), 16 * WIDTHS[0]), WIDTHS[0])]
                    code.append(sum(1 << n for n, m in enumerate(means) if m > 0))
                    data.append(v.tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code, pa.int32()), pa.array(data, pa.binary())],
                                                 names=["id", "label", "code", "x"])

    return rows.mapInArrow(run, "id long, label long, code int, x binary").distinct()


def _blocks(rows: DataFrame, per_block: int, per_part: int) -> DataFrame:
    """Rows in blocks of the same partition, with like rows side by side."""
    n = rows.count()
    order = ["label", "code", "id"]
    dealt = rows.repartitionByRange(max(1, ceil(n / per_part)), *order).sortWithinPartitions(*order, "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, per_block):
                b = batch.slice(at, per_block)
                ids, labels, data = (b.column(i).to_pylist() for i in (0, 1, 3))
                dims = max(map(len, data)) // 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                     pa.array([labels], pa.list_(pa.int64())), pa.array([dims], pa.int32()),
                     pa.array([b"".join(d.ljust(8 * dims, b"\0") for d in data)], pa.binary())],
                    names=["part", "nth", "ids", "labels", "dims", "x"])
                nth += 1

    return dealt.mapInArrow(run, _BLOCK)


def _meet(groups: DataFrame, sent: DataFrame, search, ddl: str) -> DataFrame:
    """``sent`` (grp, and anchor blocks) against the rows of their groups: a
    task takes a group's rows, then the blocks one after the other."""
    extra = [c for c in sent.columns if c not in groups.columns and c != "grp"]
    rows = groups.withColumn("grp", F.col("part")).withColumn("kind", F.lit(0))
    for c in extra:
        rows = rows.withColumn(c, F.lit(None).cast(sent.schema[c].dataType))
    both = rows.unionByName(sent.withColumn("kind", F.lit(1))).repartition("grp").sortWithinPartitions("grp", "kind", "part", "nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, blocks, held = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["grp"] != group:
                    group, blocks, held = r["grp"], [], None
                if r["kind"] == 0:
                    blocks.append(r)
                    continue
                if not blocks:
                    continue
                held = held or _joined(blocks)
                a = _vectors(r)
                dims = max(a.x.shape[1], held.x.shape[1])
                held = _aligned(held, dims)
                yield from search(r, _aligned(a, dims), held)

    return both.mapInArrow(run, ddl)


def _first(rows: DataFrame, keys: list[str], by: list, k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id", label: str = "label", vector: str = "embedding",
         positives: int = 5, negatives: int = 3, least: float = 0.5, most: float = 0.95, scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score. ``anchors`` is a condition on the rows' id column ``id``."""
    spark = rows.sparkSession
    share_code(spark)
    least_, most_ = Fraction(str(least)), Fraction(str(most))
    rows = rows.where(usable(F.col(f"`{id_col}`"), F.col(f"`{label}`"), F.col(f"`{vector}`"))).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("x"))
    coded = materialise(_coded(rows, scale), "negatives-rows")
    groups = materialise(_blocks(coded, AT_ONCE, GROUP), "negatives-groups")
    asked = materialise(_blocks(coded.where(anchors), BLOCK, 8 * BLOCK), "negatives-anchors")
    n_groups = groups.agg(F.max("part")).first()[0]
    ddl = "part int, nth int, k int, anchor_id long, positive_id long, positive_score long"

    def own(r: dict, a: Vectors, held: Vectors) -> Iterator[pa.RecordBatch]:
        found = search_positives(a, held, positives).found
        hits = [(r["part"], r["nth"], i, int(a.ids[i]), id_, -s) for i, f in enumerate(found) for s, id_ in f]
        yield _table(hits, ddl)

    labels_of = groups.select(F.col("part").alias("grp"), F.explode(F.array_distinct("labels")).alias("label")).distinct()
    wanted = asked.select("part", "nth", F.explode(F.array_distinct("labels")).alias("label"))
    sent = wanted.join(labels_of, "label").select("part", "nth", "grp").distinct().join(asked, ["part", "nth"])
    found = _first(_meet(groups, sent, own, ddl), ["part", "nth", "k"], [F.desc("positive_score"), "positive_id"], positives)
    per_block = found.groupBy("part", "nth").agg(  # at most BLOCK * positives entries
        F.collect_list(F.struct("k", "positive_id", "positive_score")).alias("wanted"))
    asked = materialise(asked.join(per_block, ["part", "nth"]), "negatives-asked")
    out = "part int, nth int, k int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"

    def others(r: dict, a: Vectors, held: Vectors) -> Iterator[pa.RecordBatch]:
        want = r["wanted"]
        scores = [w["positive_score"] for w in want]
        lowest = np.array([ceil(least_ * s) for s in scores], float)
        highest = np.array([floor(most_ * s) for s in scores], float)
        best = search_negatives(a, np.array([w["k"] for w in want]), lowest, highest, held, negatives).found
        hits = [(r["part"], r["nth"], w["k"], int(a.ids[w["k"]]), w["positive_id"], w["positive_score"], id_, -s)
                for w, f in zip(want, best) for s, id_ in f]
        yield _table(hits, out)

    sent = asked.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(n_groups if n_groups is not None else 0))))
    hits = _first(_meet(groups, sent, others, out), ["part", "nth", "k", "positive_id"],
                  [F.desc("negative_score"), "negative_id"], negatives)
    return hits.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _table(hits: list[tuple], ddl: str) -> pa.RecordBatch:
    names, kinds = zip(*(p.strip().split(" ") for p in ddl.split(",")))
    columns = list(zip(*hits)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, {"int": pa.int32(), "long": pa.int64()}[k]) for c, k in zip(columns, kinds)],
                                      names=list(names))
