"""Language identification by the nearest of several centroids per language.

A text is the vector of its character n-grams (1 to 3 letters, words padded
with a space), hashed to ``DIMS`` places, weighted by TF-IDF and scaled to
length one. Each learned language has ``per_language`` centroids from spherical
k-means over its own sample, so a language may have more than one kind of text.
A text takes the language of the centroid with the largest cosine. It is
rejected when that cosine is below the floor for its length: the smallest
cosine that a share ``1 - reject`` of the training texts of like length reach,
times ``slack``.

The fit uses at most about ``sample`` labelled rows a language (a hash of id and
text decides, so the sample is the same on every run; equal rows count once);
prediction reads whole
texts of all rows.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and rejected; rows with equal texts get equal results; of equal cosines the
language that comes first in the alphabet is taken, and a cosine equal to its
floor is kept; texts of any length are taken whole, a slice at a time; with no
labelled row every text is ``und``; an empty table gives an empty table; ids,
labels and sources are no inputs of a prediction; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.storage import share_code

DIMS = 1 << 12
#: The model is held whole by every worker, so labels are bounded.
MAX_LANGUAGES = 1_000
#: Letters of a text that are counted at once.
SLICE_CHARS = 1 << 20
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams over the whole text; None without a letter.
    Everything but letters is a word break."""
    if not text:
        return None
    total = np.zeros(DIMS, np.int64)
    some, low = False, text.lower()
    before = np.array([32], np.uint32)  # the last two characters counted, so that a slice ends no word
    for at in range(0, len(low), SLICE_CHARS):
        codes = np.frombuffer(low[at:at + SLICE_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters(codes)
        some = some or bool(letter.any())
        last = [np.array([32], np.uint32)] if at + SLICE_CHARS >= len(low) else []
        codes = np.concatenate([before, np.where(letter, codes, np.uint32(32)), *last])
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]  # one break between words
        old = len(before)
        one = codes * _MIX[0]
        two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * _MIX[1] + codes[1:] * _MIX[2]
        three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * _MIX[0] + codes[2:] * _MIX[1]
        for h in (one[old:][codes[old:] != 32], two[old - 1:], three[max(0, old - 2):]):
            total += np.bincount((h ^ (h >> np.uint32(16))) & np.uint32(DIMS - 1), minlength=DIMS)
        before = codes[-2:]
    return total if some else None


def _letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters: a table for the first 64k, and the
    letters of other planes one by one."""
    low = np.minimum(codes, 0xFFFF)
    found = _table()[low]
    for k in np.flatnonzero(codes > 0xFFFF):
        found[k] = chr(int(codes[k])).isalpha()
    return found


_LETTER_TABLE: list[np.ndarray] = []


def _table() -> np.ndarray:
    if not _LETTER_TABLE:
        _LETTER_TABLE.append(np.array([chr(c).isalpha() for c in range(0x10000)]))
    return _LETTER_TABLE[0]


def length_bin(n: np.ndarray) -> np.ndarray:
    """Bin of a text with n counted n-grams: the power of two, up to 2^12."""
    return np.minimum(np.log2(np.maximum(n, 1)).astype(int), 12)


@dataclass
class Model:
    """Languages, the centroids (one row each) and their language, IDF
    weights, and the cosine floor for each length bin."""

    languages: list[str]
    centroids: np.ndarray
    owner: np.ndarray
    idf: np.ndarray
    floor: np.ndarray

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """(rows, centroids) cosines of rows of counts."""
        x = weigh(counts, self.idf)
        return x @ self.centroids.T


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts).astype(np.float32) * idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of unit rows: start from the rows least like those taken so
    far, then mean directions."""
    taken = [int((x @ x.sum(0)).argmax())]
    near = x @ x[taken[0]]
    while len(taken) < min(k, len(x)):
        taken.append(int(near.argmin()))
        near = np.maximum(near, x @ x[taken[-1]])
    c = x[taken]
    for _ in range(rounds):
        at = (x @ c.T).argmax(1)
        new = np.zeros_like(c)
        np.add.at(new, at, x)
        size = np.linalg.norm(new, axis=1, keepdims=True)
        new = np.where(size > 0, new / np.maximum(size, 1e-12), c)
        if np.allclose(new, c, atol=1e-6):
            break
        c = new
    return c


def fit(labelled: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang", sample: int = 600,
        per_language: int = 4, reject: float = 0.001, slack: float = 0.5) -> Model | None:
    """Learn from rows with a label; the features of at most about ``sample``
    rows a language come to the driver as sparse counts."""
    share_code(labelled.sparkSession)
    rows = labelled.select(F.xxhash64(F.lit(11), F.col(f"`{id_col}`").cast("string"), F.col(f"`{text}`").cast("string")).alias("h"),
                           F.col(f"`{label}`").cast("string").alias("lang"),
                           F.col(f"`{text}`").cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = [(r["lang"], r["n"]) for r in rows.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()]
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels: not a language column")
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for g, n in sizes for x in (g, min(1.0, sample / n))])
    drawn = rows.where(F.shiftrightunsigned("h", 1).cast("double") < share[F.col("lang")] * float(1 << 63))
    drawn = drawn.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")  # equal rows once

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1)):
                c = ngram_counts(t.as_py())
                if c is not None:
                    at = np.flatnonzero(c)
                    yield pa.RecordBatch.from_pydict({"lang": [lang], "at": pa.array([at.tolist()], pa.list_(pa.int32())),
                                                      "n": pa.array([c[at].tolist()], pa.list_(pa.int32()))})

    learned: dict[str, list[np.ndarray]] = {}
    for r in drawn.mapInArrow(counted, "lang string, at array<int>, n array<int>").toLocalIterator():
        c = np.zeros(DIMS, np.int32)
        c[r["at"]] = r["n"]
        learned.setdefault(r["lang"], []).append(c)
    if not learned:
        return None
    languages = sorted(learned)
    counts = {g: np.array(sorted(learned[g], key=bytes)) for g in languages}  # no order of arrival in the result
    seen = sum((counts[g] > 0).sum(0) / len(counts[g]) for g in languages) / len(languages)
    idf = np.log(1 / np.maximum(seen, 1e-3)).astype(np.float32) + np.float32(0.05)
    each = [spherical_kmeans(weigh(counts[g], idf), per_language) for g in languages]
    model = Model(languages, np.concatenate(each).astype(np.float32),
                  np.repeat(np.arange(len(languages)), [len(c) for c in each]), idf, np.zeros(13, np.float32))
    best = np.concatenate([model.scores(counts[g]).max(1) for g in languages])
    bins = length_bin(np.concatenate([counts[g].sum(1) for g in languages]))
    floors = [np.quantile(best[bins <= b], reject) if (bins <= b).any() else 0.0 for b in range(13)]
    own = [np.quantile(best[bins == b], reject) if (bins == b).sum() >= 20 else floors[b] for b in range(13)]
    model.floor = (slack * np.minimum.accumulate(np.array(own)[::-1])[::-1]).astype(np.float32)
    return model


def judge(texts: pa.Array, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Languages, scores and whether rejected, of whole texts."""
    lang, score, out = np.full(len(texts), "und", object), np.zeros(len(texts)), np.ones(len(texts), bool)
    for at in range(0, len(texts) if model else 0, 256):
        found = [ngram_counts(t.as_py()) for t in texts.slice(at, 256)]
        some = [k for k, c in enumerate(found) if c is not None]
        if some:
            counts = np.array([found[k] for k in some])
            cos = model.scores(counts)
            best, where = cos.max(1), at + np.array(some)
            lang[where] = np.array(model.languages, object)[model.owner[cos.argmax(1)]]
            score[where] = np.clip(best, 0, 1)
            out[where] = best < model.floor[length_bin(counts.sum(1))]
    return lang, score, out


def predict(docs: DataFrame, model: Model | None, keys: list[str], text: str = "text") -> DataFrame:
    """The ``keys`` columns, lang_pred, score (cosine, 0 to 1) and rejected."""
    share_code(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
                       + ["lang_pred string", "score double", "rejected boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, out = judge(b.column(len(keys)), model)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score), pa.array(out)],
                                             names=[*keys, "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows, whole, whose text is not rejected."""
    share_code(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                b = batch.slice(k, 500)
                yield b.filter(pa.array(~judge(b.column(at), model)[2]))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id) -> F.Column:
    """The fold that a fit leaves out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))

