"""Near-duplicate embeddings: spherical k-means cells, blocked cosines within.

Equal vectors are one node. Centroids are fitted on a bounded sample; every
node goes to the cell of its most similar centroid, its home. So that no link
across a border is lost, a node is also a guest of every lower-numbered cell
that may hold a partner of it: one whose border is within the linking angle of
the node (a partner x at home there is no closer to the node's own centroid, so
the node's component along the difference of the centroids is at most the sine
of that angle), and whose farthest member is within reach. Both bounds follow
from the triangle inequality, so the links are exactly those of all pairs.

A cell's home nodes are dealt into chunks by a hash, and a chunk meets the
later chunks of its cell and the guests, block by block, in double precision.
What leaves a task is a count of links for each node and a spanning forest, not
the pairs.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components, have no links and are kept; vectors of different length
never link; repeated rows link with one another; rows with a null id take part
and the class id is the smallest non-null id; a cosine equal to the limit
links; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.components import components
from daypulse.llm.language_id import spherical_kmeans
from daypulse.llm.simhash import forest
from daypulse.llm.storage import materialise, share_code

#: Vectors that the centroids are fitted on, the most cells, home nodes in a chunk.
SAMPLE, MAX_CELLS, CHUNK = 10_000, 1_024, 1_024
_SLACK = 1e-9


def unit_rows(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of length one in double precision, padded with zeros; lengths)."""
    size = np.diff(np.asarray(lists.offsets))
    x = np.zeros((len(size), width))
    flat = np.asarray(lists.flatten(), dtype=float)
    x[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    x /= np.abs(x).max(1, keepdims=True, initial=1e-300)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True), size


def _homes(centroids: np.ndarray):
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cos = unit_rows(b.column(2), width)[0] @ centroids.T
            home = cos.argmax(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home.astype(np.int32)), pa.array(cos.max(1))],
                                             names=["node", "n", "v", "home", "cos"])

    return run


def _meetings(centroids: np.ndarray, radius: np.ndarray, chunks: np.ndarray, least: float):
    """Worker: nodes to rows (cell, chunk, side, node, n, v); side 0 is the
    chunk's own home nodes, side 1 what they meet."""
    width = centroids.shape[1]
    sine, angle = sqrt(1 - least * least), acos(least)
    apart = np.linalg.norm(centroids[:, None] - centroids[None], axis=2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                b = batch.slice(at, 2_000)
                node, home = np.asarray(b.column(0)), np.asarray(b.column(3))
                cos = unit_rows(b.column(2), width)[0] @ centroids.T
                across = cos[np.arange(len(home)), home][:, None] - cos  # along the difference of the centroids
                near = across <= sine * apart[home] + _SLACK
                near &= np.arccos(np.clip(cos, -1, 1)) <= radius[None] + angle + 1e-6
                near &= np.arange(len(centroids))[None] < home[:, None]
                own = (node * np.int64(0x9E3779B97F4A7C15 - (1 << 64)) >> np.int64(33)) % chunks[home]
                rows = [np.arange(len(node))]
                cells, chunk, side = [home], [own], [np.zeros(len(node), np.int64)]
                for c in range(int(chunks[home].max(initial=1)) - 1):  # a home node meets the chunks before its own
                    k = np.flatnonzero(own > c)
                    rows.append(k), cells.append(home[k]), chunk.append(np.full(len(k), c)), side.append(np.ones(len(k), np.int64))
                guest, cell = np.nonzero(near)
                times = chunks[cell]
                rows.append(np.repeat(guest, times)), cells.append(np.repeat(cell, times))
                chunk.append(np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
                side.append(np.ones(int(times.sum()), np.int64))
                out = b.take(pa.array(np.concatenate(rows)))
                for s in range(0, out.num_rows, 5_000):
                    o = out.slice(s, 5_000)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(np.concatenate(x)[s:s + 5_000].astype(np.int32)) for x in (cells, chunk, side)),
                         *o.columns[:3]], names=["cell", "chunk", "side", "node", "n", "v"])

    return run


def _compare(width: int, least: float):
    """Worker: sorted meetings to rows (node, links, other): links to add to a
    node's count, or, where other is not null, a link of the forest."""

    def finds(left, right, same: bool):
        ln, lc, lx, ls = left
        rn, rc, rx, rs = right
        cos = lx @ rx.T
        hit = (cos >= least) & (ls[:, None] == rs[None])
        if same:
            hit &= ln[:, None] < rn[None]
        i, j = np.nonzero(hit)
        if len(i):
            node, at = np.unique(np.concatenate([ln[i], rn[j]]), return_inverse=True)
            add = np.zeros(len(node), np.int64)
            np.add.at(add, at, np.concatenate([rc[j], lc[i]]))
            yield node, add, None
            a, b = forest(ln[i], rn[j])
            yield a, np.zeros(len(a), np.int64), b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, within = [], None, False

        def close(parts):  # the home nodes of a chunk are complete
            left = tuple(np.concatenate(x) for x in zip(*parts))
            for s in range(0, len(left[0]), CHUNK):
                block = tuple(x[s:s + CHUNK] for x in left)
                for r in range(s, len(left[0]), CHUNK):
                    yield from finds(block, tuple(x[r:r + CHUNK] for x in left), s == r)

        def emit(found):
            for node, add, other in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(add), pa.array(other, pa.int64()) if other is not None
                     else pa.nulls(len(node), pa.int64())], names=["node", "links", "other"])

        for b in batches:
            ids = np.asarray(b.column(0)).astype(np.int64) << 33 | np.asarray(b.column(1)).astype(np.int64) << 1 | np.asarray(b.column(2))
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                side, group = int(ids[i] & 1), int(ids[i] >> 1)
                x, size = unit_rows(b.column(5).slice(i, j - i), width)
                part = (np.asarray(b.column(3))[i:j], np.asarray(b.column(4))[i:j], x, size)
                if group != key:
                    if within:
                        yield from emit(close(held))
                    held, key, within = [], group, not side
                if not side:
                    held.append(part)
                elif held:
                    if within:
                        yield from emit(close(held))
                        held, within = [tuple(np.concatenate(y) for y in zip(*held))], False
                    for s in range(0, len(part[0]), CHUNK):
                        for r in range(0, len(held[0][0]), CHUNK):
                            yield from emit(finds(tuple(y[r:r + CHUNK] for y in held[0]), tuple(y[s:s + CHUNK] for y in part), False))
        if within:
            yield from emit(close(held))

    return run


def near_duplicates(rows: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row: the id, n_links, component_id and kept (whether it represents
    its class)."""
    spark = rows.sparkSession
    share_code(spark)
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") + F.lit(0.0))  # one zero
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    every = rows.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).withColumn("ok", F.coalesce(ok, F.lit(False)))
    every = every.withColumns({"h1": F.when(F.col("ok"), F.xxhash64(F.lit(1), "v")), "h2": F.when(F.col("ok"), F.xxhash64(F.lit(2), "v"))})
    nodes = every.where("ok").groupBy("v", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("w")).first()
    n, width = sizes["n"], sizes["w"]
    if n:
        share = max(1, n // SAMPLE)
        drawn = nodes.where(F.pmod("h1", F.lit(share)) == 0).select("v").limit(2 * SAMPLE).toArrow()["v"].combine_chunks()
        sample = unit_rows(drawn, width)[0] if len(drawn) else np.eye(1, width)
        sample = sample[np.lexsort(sample.T)]  # no order of arrival in the result
        centroids = spherical_kmeans(sample, min(MAX_CELLS, max(1, ceil(sqrt(n) / 4))))
        homes = materialise(nodes.select("node", "n", "v").mapInArrow(
            _homes(centroids), "node long, n long, v array<double>, home int, cos double"), "homes")
        radius, chunks = np.zeros(len(centroids)), np.ones(len(centroids), np.int64)
        for r in homes.groupBy("home").agg(F.min("cos").alias("c"), F.count(F.lit(1)).alias("n")).collect():  # a row for each cell
            radius[r["home"]] = acos(min(1.0, max(-1.0, r["c"])))
            chunks[r["home"]] = ceil(r["n"] / CHUNK)
        meet = homes.mapInArrow(_meetings(centroids, radius, chunks, least),
                                "cell int, chunk int, side int, node long, n long, v array<double>")
        found = meet.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "side").mapInArrow(
            _compare(width, least), "node long, links long, other long")
        found = materialise(found, "vector-links")
        roots = materialise(components(found.where("other IS NOT NULL"), "node", "other"), "vector-roots")
        links = materialise(found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links")), "vector-counts")
        nodes = nodes.select("h1", "h2", "n", "low", "node").join(links, "node", "left").join(roots, "node", "left").withColumn(
            "root", F.coalesce("root", "node"))
    else:
        nodes = nodes.select("h1", "h2", "n", "low", "node", F.lit(0).cast("long").alias("links"), F.col("node").alias("root"))
    nodes = materialise(nodes, "vector-nodes")
    lows = materialise(nodes.groupBy("root").agg(F.min("low").alias("component_id")), "vector-lows")
    nodes = materialise(nodes.join(lows, "root").select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                                        "component_id"), "vector-classes")
    out = every.select("id", "ok", "h1", "h2").join(nodes, ["h1", "h2"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
