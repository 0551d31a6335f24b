"""Quality by co-training: a text view and a metadata view teach each other.

The text view sees shares of bytes, of runs of three character classes, and
how often words and lines repeat; the metadata view sees the source, the
language and the length. Each is a ridge logistic regression. Per round, each
view scores every unlabelled row in Spark, and all rows that it is confident of
(log odds beyond ``confident``) become labelled rows of the other view, which is
fitted anew; the next round's scores take the place of the last one's. Both
views are then calibrated (Platt) on labelled rows that took no part, and a
document's score adds the calibrated log odds of the views around the prior.
The score below which a document is rejected is the one that errs least on those
rows, a lost good row counting as ``dear`` kept bad ones, so a few wrong labels
at the end of one class do not move it.

A fit takes bounded samples of labelled rows, the first by a hash of their ids:
``sample`` ids with a given label, as many more for calibration, and of the
rows that a view is confident of at most ``sample / 2`` a class, with weights: all
confident rows of a class together weigh as many rows as there are, at most as
many as the labelled ones of that class. Everything else reads whole texts of
all rows.

Defined results: a null or empty text has all-zero text features; null
metadata is a value of its own; several labels of one id count by their mean;
labels without a document and documents without a label are allowed, rows
without an id are unlabelled; with labels of less than two classes in either
sample there is no model, every score is 0.5 and every row is kept; a score equal
to the threshold is kept; repeated rows get equal scores; a text of any length is
taken whole, at some 60 bytes a word; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.storage import free_name, materialise, share_code

#: lower, upper, digit, blank, line end, mark, other byte, control
_CLASS = np.array([3 if c in (32, 9) else 4 if c in (10, 13) else 7 if c < 32 or c == 127 else 2 if 48 <= c <= 57 else
                   1 if 65 <= c <= 90 else 0 if 97 <= c <= 122 else 5 if c < 128 else 6 for c in range(256)], np.int64)
TEXT_DIMS, META_DIMS = 256 + 512 + 8, 256 + 64 + 32
_SLICE = 1 << 20


def text_features(text: bytes | None) -> np.ndarray:
    """Features of a whole text (UTF-8)."""
    out = np.zeros(TEXT_DIMS, np.float32)
    if not text:
        return out
    byte, runs = np.zeros(256, np.int64), np.zeros(512, np.int64)
    for at in range(0, len(text), _SLICE):
        b = np.frombuffer(text, np.uint8, min(_SLICE + 2, len(text) - at), at)
        byte += np.bincount(b[:_SLICE], minlength=256)
        c = _CLASS[b]
        if len(c) > 2:
            runs += np.bincount(c[:-2] * 64 + c[1:-1] * 8 + c[2:], minlength=512)
    out[:256] = np.sqrt(byte / len(text))
    out[256:768] = np.sqrt(runs / max(1, runs.sum()))
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n = max(1, len(words))
    out[768:] = (np.log1p(len(set(words))) / np.log1p(n), len(set(lines)) / max(1, len(lines)), min(20, len(text) / n) / 20,
                 sum(a == b for a, b in zip(words, words[1:])) / n, np.log1p(n) / 12, len(set(words)) / n,
                 n / max(1, len(lines)) / (1 + n / max(1, len(lines))), sum(w.isalpha() for w in words) / n)
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META_DIMS, np.float32)
    out[zlib.crc32(repr(source).encode()) % 256] = 1
    out[256 + zlib.crc32(repr(lang).encode()) % 64] = 1
    out[320 + (31 if n_chars is None else min(30, max(0, int(n_chars)).bit_length()))] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last is the intercept, not shrunk) by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(float)
    each = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (each * (p * (1 - p) + 1e-6))[:, None]).T @ x
        step = np.linalg.solve(h + np.diag(shrink), x.T @ (each * (p - y)) + shrink * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


@dataclass
class Model:
    """Weights and Platt (slope, intercept) of each view, the prior's log
    odds, and the score below which a document is rejected."""

    text: np.ndarray
    meta: np.ndarray
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float
    threshold: float

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, ...]:
        a = self.text_scale[0] * odds(text, self.text) + self.text_scale[1]
        b = self.meta_scale[0] * odds(meta, self.meta) + self.meta_scale[1]
        both = np.clip(a + b - self.prior, -30, 30)
        return tuple(1 / (1 + np.exp(-z)) for z in (both, np.clip(a, -30, 30), np.clip(b, -30, 30)))


@dataclass
class Sure:
    """What a view is confident of: features of a bounded number of rows a
    class, their labels, and how many rows of classes 0 and 1 there are."""

    text: np.ndarray
    meta: np.ndarray
    y: np.ndarray
    rows: tuple[int, int]


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: tuple[np.ndarray, np.ndarray, np.ndarray],
             confident_rows: Callable[[list[np.ndarray], float], list[Sure]], rounds: int = 3, confident: float = 0.98,
             dear: float = 5.0) -> Model | None:
    """Learn from labelled rows (text, meta, y) and all that the views are
    confident of. ``confident_rows`` (weights of both views, least log odds)
    tells that for each view; ``held`` are labelled rows for calibration."""
    if len(set(y.tolist())) < 2 or len(set(held[2].tolist())) < 2:
        return None
    views, limit = [text, meta], float(np.log(confident / (1 - confident)))
    w = [logistic(v, y) for v in views]
    own = [max(1, int((y == c).sum())) for c in (0, 1)]
    for _ in range(rounds):
        sure = confident_rows(w, limit)
        if not any(sum(s.rows) for s in sure):
            break
        for b in (0, 1):
            s = sure[1 - b]  # the other view's
            if not len(s.y):
                continue
            more = (s.text, s.meta)[b]
            each = [min(s.rows[c], own[c]) / max(1, int((s.y == c).sum())) for c in (0, 1)]
            weight = np.concatenate([np.ones(len(y)), np.where(s.y == 1, each[1], each[0])])
            w[b] = logistic(np.vstack([views[b], more]), np.concatenate([y, s.y]), weight=weight)
    scales, prior = [], float(np.log(held[2].mean() / (1 - held[2].mean())))
    for v, x in ((0, held[0]), (1, held[1])):
        s = logistic(odds(x, w[v])[:, None], held[2], ridge=0.05)
        scales.append((float(s[0]), float(s[1])) if s[0] > 0 else (0.0, prior))
    model = Model(*w, *scales, prior, 0.5)
    model.threshold = threshold(model.score(held[0], held[1])[0], held[2], dear)
    return model


def threshold(score: np.ndarray, y: np.ndarray, dear: float) -> float:
    """The cut, at most 0.5, of least cost: ``dear`` for the share of good rows
    below it, 1 for the share of bad rows that are not. Among equal ones the
    middle of the widest gap."""
    at = np.unique(np.concatenate([[0.0], score[score <= 0.5], [0.5]]))
    cut = (at[1:] + at[:-1]) / 2
    good, bad = np.sort(score[y == 1]), np.sort(score[y == 0])
    cost = dear * np.searchsorted(good, cut) / len(good) + 1 - np.searchsorted(bad, cut) / len(bad)
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    return float(cut[best[np.diff(at)[best].argmax()]])


def _features(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and both views' features as float lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(keys)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                s = b.slice(at, 500)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                         for x in _both(*s.columns[k:])]
                yield pa.RecordBatch.from_arrays([*s.columns[:k], *lists], names=[*keys, "t", "m"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(keys)])
    return rows.mapInArrow(run, f"{head}, t array<float>, m array<float>")


def _views(docs: DataFrame, keys: list) -> DataFrame:
    return docs.select(*keys, *[F.col(c).cast("long" if c == "n_chars" else "string").alias(free_name(docs, f"__{c}"))
                                for c in ("text", "source", "lang", "n_chars")])


def _one_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each of the keys, combined before it moves: the smallest by
    a hash, then by its values, so that every run takes the same."""
    rest = [c for c in rows.columns if c not in keys]
    least = F.min(F.struct(F.xxhash64(*rest).alias("__hash"), *rest)).alias("__row")
    return rows.groupBy(*keys).agg(least).select(*keys, *[f"__row.{c}" for c in rest])


def _matrix(rows: pa.Table, name: str, dims: int) -> np.ndarray:
    return rows.column(name).combine_chunks().flatten().to_numpy().reshape(-1, dims)


def _taught(docs: DataFrame, chosen: DataFrame, keys: list[str]) -> pa.Table:
    """Features of one row of each chosen id, in order of the ids."""
    rows = _views(docs.join(F.broadcast(chosen), "doc_id"), keys)
    return _features(_one_each(rows, keys), keys).toArrow().sort_by([(k, "ascending") for k in keys])


def _sure(docs: DataFrame, labelled: DataFrame, sample: int) -> Callable[[list[np.ndarray], float], list[Sure]]:
    """Scores all unlabelled rows of docs by both views, each time it is called."""
    names = ["view", "label", "h", "doc_id"]

    def ask(w: list[np.ndarray], limit: float) -> list[Sure]:
        rows = _views(docs, ["doc_id"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 500):
                    s = b.slice(at, 500)
                    t, m = _both(*s.columns[1:])
                    found = [(v, c, r) for v, x in ((0, t), (1, m)) for z in [odds(x, w[v])]
                             for c, sure in ((1, z >= limit), (0, z <= -limit)) for r in np.flatnonzero(sure).tolist()]
                    view, label, place = (pa.array([f[i] for f in found], pa.int32()) for i in range(3))
                    yield pa.RecordBatch.from_arrays([view, label, s.column(0).take(place)], names=["view", "label", "doc_id"])

        kind = docs.schema["doc_id"].dataType.simpleString()
        sure = rows.mapInArrow(run, f"view int, label int, doc_id {kind}")
        # Labelled ids are no unlabelled rows; those without an id are.
        sure = sure.join(labelled.select("doc_id"), "doc_id", "left_anti")
        sure = materialise(sure.groupBy("view", "label", "doc_id").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "h", F.xxhash64(F.lit(23), "doc_id")), "quality-sure")
        counts = {(r["view"], r["label"]): r["n"] for r in sure.groupBy("view", "label").agg(F.sum("n").alias("n")).collect()}
        first = None
        for key in sorted(counts):  # the first rows by their hash, at most `sample` each
            some = sure.where((F.col("view") == key[0]) & (F.col("label") == key[1]) & F.col("doc_id").isNotNull())
            some = some.select(*names).orderBy("h", "doc_id").limit(sample)
            first = some if first is None else first.unionByName(some)
        empty = Sure(np.zeros((0, TEXT_DIMS)), np.zeros((0, META_DIMS)), np.zeros(0), (0, 0))
        if first is None:
            return [empty, empty]
        got = _taught(docs, first.drop("h"), ["view", "label", "doc_id"])
        out = []
        for v in (0, 1):
            own = got.filter(pc.equal(got.column("view"), v))
            out.append(Sure(_matrix(own, "t", TEXT_DIMS), _matrix(own, "m", META_DIMS), own.column("label").to_numpy().astype(float),
                            (counts.get((v, 0), 0), counts.get((v, 1), 0))) if own.num_rows else empty)
        return out

    return ask


def fit(docs: DataFrame, labels: DataFrame, sample: int = 3_000, **options) -> Model | None:
    """Learn from ``labels`` (doc_id, quality 0 or 1) of ``docs``."""
    share_code(docs.sparkSession)
    marked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("y")).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    marked = materialise(marked.withColumn("h", F.xxhash64(F.lit(21), "doc_id")), "quality-labels")
    chosen = marked.orderBy("h", "doc_id").limit(2 * sample)  # so it may be broadcast
    taught = _taught(docs, chosen.drop("h"), ["doc_id", "y"])
    if not taught.num_rows:
        return None
    text, meta, y = _matrix(taught, "t", TEXT_DIMS), _matrix(taught, "m", META_DIMS), taught.column("y").to_numpy().astype(float)
    held = np.arange(len(y)) % 2 == 1
    return co_train(text[~held], meta[~held], y[~held], (text[held], meta[held], y[held]), _sure(docs, marked, max(1, sample // 2)), **options)


def _both(texts: pa.Array, sources: pa.Array, langs: pa.Array, chars: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of both views."""
    t = np.array([text_features(x.as_py()) for x in texts.cast(pa.binary())], np.float32).reshape(-1, TEXT_DIMS)
    m = np.array([meta_features(*x) for x in zip(*(c.to_pylist() for c in (sources, langs, chars)))], np.float32)
    return t, m.reshape(-1, META_DIMS)


def judge(texts: pa.Array, sources: pa.Array, langs: pa.Array, chars: pa.Array, model: Model | None) -> np.ndarray:
    """(3, rows): the combined, the text and the metadata score."""
    found = np.full((3, len(texts)), 0.5)
    for at in range(0, len(texts) if model else 0, 500):
        found[:, at:at + 500] = model.score(*_both(*(c.slice(at, 500) for c in (texts, sources, langs, chars))))
    return found


def score(docs: DataFrame, model: Model | None, keys: list[str]) -> DataFrame:
    """The ``keys`` columns, quality (the combined score), text_score,
    meta_score (0 to 1 each) and rejected."""
    share_code(docs.sparkSession)
    rows = _views(docs, [F.col(f"`{k}`") for k in keys])
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(keys)])
    least = model.threshold if model else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = judge(*b.columns[len(keys):], model)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keys)], *(pa.array(f) for f in found), pa.array(found[0] < least)],
                                             names=[*keys, "quality", "text_score", "meta_score", "rejected"])

    return rows.mapInArrow(run, f"{head}, quality double, text_score double, meta_score double, rejected boolean")


def keep_good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows, whole, that are not rejected."""
    share_code(docs.sparkSession)
    rows = _views(docs, [F.col(f"`{c}`") for c in docs.columns])
    n, least = len(docs.columns), model.threshold if model else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                s = b.slice(at, 500)
                kept = judge(*s.columns[n:], model)[0] >= least
                yield pa.RecordBatch.from_arrays(s.columns[:n], names=b.schema.names[:n]).filter(pa.array(kept))

    return rows.mapInArrow(run, docs.schema)
