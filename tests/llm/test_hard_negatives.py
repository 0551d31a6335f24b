"""Hard negatives and their bounds against all pairs."""

import math

import numpy as np
import pytest
from helpers import rows_of, with_clashes
from pyspark.sql import functions as F

import __spark_entry__ as entry
from daypulse.llm import hard_negatives as hn

SF = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, positives=5, negatives=3, scale=256):
    """rows: (id, vector, label), usable ones."""
    ints = [(i, [math.floor(scale * float(np.float32(x))) for x in v], g) for i, v, g in rows]
    dims = max((len(v) for _, v, _ in ints), default=0)
    x = np.array([v + [0] * (dims - len(v)) for _, v, _ in ints], dtype=object).reshape(len(ints), dims)
    out = []
    for a, (i, _, g) in enumerate(ints):
        if i % every:
            continue
        scores = [int(s) for s in x @ x[a]] if dims else [0] * len(ints)
        own = sorted((-s, j) for s, (j, _, h) in zip(scores, ints) if h == g and j != i)[:positives]
        others = sorted((-s, j) for s, (j, _, h) in zip(scores, ints) if h != g)
        for s, j in own:
            fit = [(n, -t) for t, n in others if 50 * -s <= 100 * -t <= 95 * -s]
            out += [(i, j, k + 1, n, -s, t) for k, (n, t) in enumerate(fit[:negatives])]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def test_query_equals_all_pairs(spark):
    got = entry.queries()["op13_hard_negatives"](spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert rows_of(got) == brute(rows)


def clustered(n, dims, seed, hot=0.4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, dims)) / np.sqrt(dims)
    own = np.where(r.random(n) < hot, 0, r.integers(0, 8, n))
    x = centres[own] + r.normal(size=(n, dims)) * 0.4 / np.sqrt(dims)
    labels = np.where(r.random(n) < hot, 1, r.integers(0, 5, n))
    return [(int(i), [float(v) for v in row.astype(np.float32)], int(g)) for i, (row, g) in enumerate(zip(x, labels))]


@pytest.mark.parametrize("dims", [1, 5, 40])
def test_small_groups_and_blocks_lose_nothing(spark, monkeypatch, dims):
    for name, n in (("GROUP", 40), ("BLOCK", 3), ("AT_ONCE", 16)):
        monkeypatch.setattr(hn, name, n)
    rows = clustered(400, dims, dims)
    rows += [(1_000 + i, rows[3][1], rows[3][2]) for i in range(150)]  # one vector in a share of all rows
    got = hn.mine(frame(spark, rows).repartition(5), F.col("id") % 20 == 0)
    assert rows_of(got) == brute(rows, every=20)


def test_bounds_hold_and_become_finer():
    r = np.random.default_rng(3)
    a, b = (np.floor(256 * (r.normal(size=(50, 37)) * r.random((50, 1)) + r.normal(size=(50, 1)))) for _ in range(2))
    exact, last = a @ b.T, np.inf
    for width in hn.WIDTHS:
        low, high = hn.bounds(hn.summary(a, width), hn.summary(b, width), width)
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low).mean() < last
        last = (high - low).mean()


def test_filter_leaves_rows_out():
    """On clustered vectors most rows never get as far as an exact score."""
    x = [np.array([v for _, v, _ in clustered(2_000, 64, 9)]) * 256]
    v = hn.Vectors(np.arange(2_000), np.zeros(2_000, np.int64), np.floor(x[0]).astype(np.int64))
    a = v.take(np.arange(0, 2_000, 400))
    top = np.sort(hn.score(a, v), axis=1)[:, -20].astype(float)
    at, mask = hn.candidates(a, v, np.ones((len(a), len(v)), bool), top, np.full(len(a), np.inf))
    assert mask.mean() < 0.6
    exact = hn.score(a, v)
    for i in range(len(a)):
        assert set(np.flatnonzero(exact[i] >= top[i])) <= set(at[mask[i]])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(60, 6, 2)
    odd = [(None, [1.0] * 6, 1), (600, None, 1), (650, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (700, [nan] * 6, 1), (750, [inf] * 6, 2),
           (800, [1.0] * 6, None), (850, [], 1), (900, [0.5, 0.25], 1), (950, [0.0] * 6, 2), (1_000, [1e5, -1e5, 0.0, 0.0, 0.0, 0.0], 2),
           (1_001, [9e4, -9e4, 0.0, 0.0, 0.0, 0.0], 2), (1_002, [8e4, -8e4, 0.0, 0.0, 0.0, 0.0], 1)]
    kept = [o for o in odd if o[0] is not None and o[2] is not None and o[1] is not None and all(
        v is not None and math.isfinite(v) for v in o[1])]
    table = frame(spark, rows + odd + rows[:10])  # repeated rows count once
    got = hn.mine(with_clashes(table), F.col("id") % 10 == 0)
    assert rows_of(got) == brute(rows + kept, every=10)
    assert hn.mine(table.limit(0), F.col("id") % 10 == 0).collect() == []
    with pytest.raises(Exception, match="62 bits"):
        hn.mine(frame(spark, [(0, [1e30], 1)]), F.col("id") % 10 == 0).collect()
