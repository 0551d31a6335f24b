"""Language, quality, mixing, vectors and the pipeline."""

import zlib
from collections import Counter
from math import log

import numpy as np
import pytest
from helpers import docs_frame, odd_docs, rows_of, with_clashes
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from daypulse.llm import language_id, mixing, quality, vector_dedup
from daypulse.llm.storage import row_hash

SF, SF_MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- language -------------------------------------------------------------

def test_language_on_held_out_rows(spark):
    got = entry.queries()["op8_nearest_centroid"](spark, SF_MORE).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MORE}/documents.parquet").collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_language_odd_rows(spark):
    docs = odd_docs(spark)
    model = language_id.fit(docs)
    got = language_id.predict(with_clashes(docs), model, ["doc_id"]).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for i in (1, 2, 3, 9):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[6].lang_pred == by[7].lang_pred == "fr" and by[8].lang_pred in {"en", "fr", "xx"}
    assert language_id.fit(docs.where("lang IS NULL")) is None
    assert {r.lang_pred for r in language_id.predict(docs, None, ["doc_id"]).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model, ["doc_id"]).collect() == []


def test_counts_do_not_depend_on_slices(monkeypatch):
    text = "Ein längerer Satz, über 𐐀 viele Wörter. " * 50
    whole = language_id.ngram_counts(text)
    assert whole.sum() > 0 and (language_id.ngram_counts("😀 12") is None)
    for n in (100, 1, 2, 3):
        monkeypatch.setattr(language_id, "SLICE_CHARS", n)
        assert (language_id.ngram_counts(text) == whole).all()


def plain_counts(text):
    """Counts of the hashed n-grams of words between single breaks, one by one."""
    low, out = text.lower(), Counter()
    chars = [ord(c) if c.isalpha() else 32 for c in f" {low} "]
    chars = [c for k, c in enumerate(chars) if not k or c != 32 or chars[k - 1] != 32]
    a, b, c = (int(x) for x in language_id._MIX)
    for k, x in enumerate(chars):
        one = x * a % 2**32
        grams = [one] if x != 32 else []
        if k + 1 < len(chars):
            two = ((one ^ one >> 15) * b + chars[k + 1] * c) % 2**32
            grams.append(two)
            if k + 2 < len(chars):
                grams.append(((two ^ two >> 13) * a + chars[k + 2] * b) % 2**32)
        out.update((h ^ h >> 16) % language_id.DIMS for h in grams)
    return out


def test_prediction_equals_one_by_one(spark):
    """Counts, weights, cosines, floors and ties of op 8 against plain Python."""
    docs = odd_docs(spark).unionByName(spark.read.parquet(f"{SF}/documents.parquet").limit(60))
    model = language_id.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    for r in language_id.predict(docs, model, ["doc_id", "text"]).collect():
        if not any(ch.isalpha() for ch in r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        counts = plain_counts(r.text)
        assert {int(k): int(v) for k, v in enumerate(language_id.ngram_counts(r.text)) if v} == dict(counts)
        x = np.zeros(language_id.DIMS)
        for k, v in counts.items():
            x[k] = np.log1p(v) * model.idf[k]
        cosines = model.centroids @ (x / np.linalg.norm(x))
        best = int(cosines.argmax())
        assert r.score == pytest.approx(min(1, max(0, cosines[best])), abs=1e-5)
        assert model.languages[model.owner[best]] == r.lang_pred or np.sort(cosines)[-2] > cosines[best] - 1e-5
        floor = model.floor[min(12, int(np.log2(sum(counts.values()))))]
        assert r.rejected == (cosines[best] < floor) or abs(cosines[best] - floor) < 1e-5


# --- quality --------------------------------------------------------------

def test_quality_on_rows_that_were_not_fitted(spark):
    docs, labels = (spark.read.parquet(f"{SF_MORE}/{t}.parquet") for t in ("documents", "labels"))
    other = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    model = quality.fit(docs, labels.where(~other))
    full = quality.score(docs, model, ["doc_id"]).join(labels.where(other).withColumnRenamed("quality", "y"), "doc_id").toPandas()
    good, bad = full[full.y == 1], full[full.y == 0]
    assert good.rejected.mean() <= 0.02 and bad.rejected.mean() >= 0.9
    assert full.quality.between(0, 1).all()


def test_quality_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0), labels.where("quality = 1")):
        got = quality.score(with_clashes(docs), quality.fit(docs, given), ["doc_id"]).collect()
        assert len(got) == docs.count() and all(0 <= r.quality <= 1 for r in got)
        assert not any(r.rejected for r in got)  # too few labels for a model
    assert quality.fit(docs.limit(0), labels) is None
    assert quality.score(docs.limit(0), None, ["doc_id"]).collect() == []


def in_memory(pool_text, pool_meta, sample=10**9, order=None):
    """What the Spark pool answers, from arrays; ``order``: rows by their hash."""
    order = np.arange(len(pool_text)) if order is None else order

    def ask(w, limit):
        out = []
        for v, pool in ((0, pool_text), (1, pool_meta)):
            z = quality.odds(pool, w[v])
            sure = [order[(z <= -limit)[order]], order[(z >= limit)[order]]]
            at = np.concatenate([s[:sample] for s in sure]).astype(int)
            y = np.concatenate([np.full(len(s[:sample]), float(c)) for c, s in enumerate(sure)])
            out.append(quality.Sure(pool_text[at], pool_meta[at], y, (len(sure[0]), len(sure[1]))))
        return out

    return ask


def test_views_teach_each_other():
    """One view sees the class, the other a hint of it that labelled rows
    alone do not show: pseudo-labels do."""
    r = np.random.default_rng(1)
    y = np.array([0, 1, 1, 0, 1] * 8)
    a = np.eye(2, dtype=np.float32)[y] * 4 + r.normal(0, .1, (40, 2)).astype(np.float32)
    b = np.zeros((40, 3), np.float32)
    py = r.integers(0, 2, 400)
    pa_ = np.eye(2, dtype=np.float32)[py] * 4 + r.normal(0, .1, (400, 2)).astype(np.float32)
    pb = np.zeros((400, 3), np.float32)
    pb[np.arange(400), py] = 1
    held = (a[::4], b[::4], y[::4])
    alone = quality.co_train(a, b, y, held, in_memory(pa_, pb), rounds=0)
    taught = quality.co_train(a, b, y, held, in_memory(pa_, pb), rounds=3, confident=0.9)
    assert np.abs(alone.meta[:2]).max() < 1e-6
    assert taught.meta[1] - taught.meta[0] > 1


@pytest.mark.parametrize("sample", [40, 400])
def test_fit_over_all_unlabelled_rows_equals_the_plain_loop(spark, sample):
    """Scoring and exchange in Spark against arrays: bounded samples cut in
    at 40 ids, none does at 400; a repeated row counts as often as it is there."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.unionByName(docs.where("doc_id % 5 = 0"))
    labels = labels.where("doc_id % 3 <> 0")
    hashes = {r.doc_id: (r.a, r.b) for r in docs.select("doc_id", F.xxhash64(F.lit(21), "doc_id").alias("a"),
                                                        F.xxhash64(F.lit(23), "doc_id").alias("b")).distinct().collect()}
    rows = docs.collect()
    marks = {}
    for r in labels.collect():
        if r.quality is not None and r.doc_id in hashes:
            marks.setdefault(r.doc_id, []).append(r.quality)
    features = {r.doc_id: (quality.text_features((r.text or "").encode()), quality.meta_features(r.source, r.lang, r.n_chars))
                for r in rows}
    own = sorted(sorted(marks, key=lambda i: hashes[i][0])[:2 * sample])
    y = np.array([float(np.mean(marks[i]) >= 0.5) for i in own])
    t, m = (np.array([features[i][v] for i in own]) for v in (0, 1))
    hold = np.arange(len(own)) % 2 == 1
    pool = [r.doc_id for r in rows if r.doc_id not in marks]
    ids = sorted(set(pool), key=lambda i: hashes[i][1])

    def ask(w, limit):
        out = []
        for v in (0, 1):
            z = {i: quality.odds(features[i][v][None], w[v])[0] for i in ids}
            sure = [[i for i in ids if z[i] <= -limit], [i for i in ids if z[i] >= limit]]
            taken = [(c, i) for c in (0, 1) for i in sorted(sure[c][:sample // 2])]
            out.append(quality.Sure(*(np.array([features[i][k] for _, i in taken]).reshape(len(taken), -1) for k in (0, 1)),
                                    np.array([float(c) for c, _ in taken]), tuple(sum(i in set(s) for i in pool) for s in sure)))
        return out

    options = {"rounds": 2, "confident": 0.8}
    want = quality.co_train(t[~hold], m[~hold], y[~hold], (t[hold], m[hold], y[hold]), ask, **options)
    got = quality.fit(docs, labels, sample, **options)
    assert np.allclose(got.text, want.text, atol=1e-4) and np.allclose(got.meta, want.meta, atol=1e-4)
    assert got.threshold == pytest.approx(want.threshold, abs=1e-4) and got.prior == want.prior
    kept = {r.doc_id for r in quality.keep_good(docs, got).select("doc_id").collect()}
    scores = {i: got.score(f[0][None], f[1][None])[0][0] for i, f in features.items()}
    assert kept == {i for i, s in scores.items() if s >= got.threshold}


def test_threshold_weighs_both_classes():
    score, y = np.array([.01, .02, .03, .2, .6, .9, .95, .99]), np.array([0, 0, 0, 0, 1, 1, 1, 1])
    assert quality.threshold(score, y, 5.0) == pytest.approx(0.35)
    y[0] = 1  # one wrong label far down does not move it
    assert quality.threshold(np.tile(score, 9), np.concatenate([y, np.tile([0, 0, 0, 0, 1, 1, 1, 1], 8)]), 5.0) == pytest.approx(0.35)
    assert quality.threshold(np.array([.7, .8]), np.array([0, 1]), 5.0) <= 0.5


def test_fits_collect_one_row_for_each_id(spark, monkeypatch):
    """One id with most of the rows, labelled or not, and equal rows without an id."""
    texts = [(i, f"words of text {i} " * 3, "en", "a") for i in range(40)]
    hot = [(7, "a hot labelled row", "en", "a")] * 300 + [(30, "a hot row of the pool", "en", "a")] * 300
    docs = docs_frame(spark, texts + hot + [(None, "no id but equal", "en", "a")] * 300)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(20)], "doc_id long, quality int")
    frames, features, iterate = [], quality._features, type(docs).toLocalIterator

    def seen(rows, keys):
        frames.append((rows, keys))
        return features(rows, keys)

    monkeypatch.setattr(quality, "_features", seen)
    assert quality.fit(docs, labels, confident=0.51) is not None
    assert frames[0][0].count() == 20 and len(frames) > 1
    for rows, keys in frames:
        assert rows.count() == rows.select(*keys).distinct().count() <= 4 * 40
    monkeypatch.undo()
    brought = []

    def counted(self, *a, **b):
        brought.extend(iterate(self, *a, **b))
        return iter(brought)

    monkeypatch.setattr(type(docs), "toLocalIterator", counted)
    assert language_id.fit(docs).languages == ["en"]
    assert len(brought) == 43


def test_filters_keep_whole_rows_and_clashing_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF_MORE}/{t}.parquet") for t in ("documents", "labels"))
    extra = docs
    for name in ("__text", "t", "m", "view", "label", "h", "quality", "rejected", "lang_pred", "score", "n", "y"):
        extra = extra.withColumn(name, F.concat(F.lit("own "), F.col("doc_id").cast("string")))
    model, speech = quality.fit(docs, labels, rounds=1), language_id.fit(docs)
    for kept, scored in ((quality.keep_good(extra, model), quality.score(docs, model, ["doc_id"])),
                         (language_id.keep_known(extra, speech), language_id.predict(docs, speech, ["doc_id"]))):
        want = {r.doc_id for r in scored.collect() if not r.rejected}
        rows = kept.collect()
        assert {r.doc_id for r in rows} == want and len(rows) == len(want)
        assert all(r.quality == r.label == f"own {r.doc_id}" for r in rows)


# --- mixing ---------------------------------------------------------------

def brute_exponent(tokens, budget, entropy, limit):
    p = np.array(tokens, float) / sum(tokens)

    def at(a):
        w = p ** a / (p ** a).sum()
        return -(w * np.log(w)).sum() / (log(len(p)) if len(p) > 1 else 1) if len(p) > 1 else 1.0, (w * budget / np.array(tokens)).max()

    def find(test):
        lo, hi = 0.0, 1.0
        for _ in range(28):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if test(mid) else (lo, mid)
        return lo, hi

    a = 1.0 if at(1.0)[0] >= entropy else find(lambda x: at(x)[0] >= entropy)[0]
    return a if at(a)[1] <= limit else find(lambda x: at(x)[1] > limit)[1]


def check_mix(docs, budget=None, entropy=0.95, limit=4.0, seed=17):
    drawn = mixing.mix(docs, budget, entropy, limit, seed).collect()
    keyed = docs.withColumn("__row", row_hash(docs))
    block, rest = mixing._keys(keyed, "source", "doc_id", seed)
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    rows = keyed.select("doc_id", "text", key.alias("s"), mixing.n_tokens(F.col("text")).alias("t"), block.alias("block"),
                        rest.alias("rest"))
    epochs = F.explode(F.sequence(F.lit(0), F.lit(6)))
    every = rows.withColumn("e", epochs).withColumn("k", mixing.order_key(F.col("s"), F.col("block"), F.col("rest"), F.col("e"), seed))
    every = every.collect()
    tokens = Counter()
    for r in every:
        if r.e == 0:
            tokens[r.s] += r.t
    total = sum(tokens.values())
    budget = int(min(budget or total, limit * total))
    live = sorted(s for s in tokens if tokens[s])
    a = brute_exponent([tokens[s] for s in live], budget, entropy, limit)
    p = np.array([tokens[s] / total for s in live])
    w = dict(zip(live, p ** a / (p ** a).sum()))
    want, spent = Counter(), 0
    for s in tokens:
        if not tokens[s]:
            want.update((r.doc_id, r.text, 0, r.k) for r in every if r.s == s and r.e == 0)
            continue
        target = int(w[s] * budget * (1 + 1e-12) + 1e-6)
        whole, left = divmod(target, tokens[s])
        for e in range(whole):
            want.update((r.doc_id, r.text, e, r.k) for r in every if r.s == s and r.e == e)
        for k in sorted({r.k for r in every if r.s == s and r.e == whole}):
            same = [r for r in every if r.s == s and r.e == whole and r.k == k]
            left -= sum(r.t for r in same)
            if left < 0:
                break
            want.update((r.doc_id, r.text, whole, k) for r in same)
        spent += target
    assert spent <= budget
    assert Counter((r.doc_id, r.text, r.mix_epoch, r.mix_key) for r in drawn) == want
    assert all(r.mix_block == r.mix_key >> 48 for r in drawn)
    return drawn, w, tokens


def test_mixing_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    check_mix(docs)
    drawn, w, tokens = check_mix(docs, entropy=1.0, limit=2.0, budget=None)
    assert max(Counter(r.doc_id for r in drawn).values()) <= 3
    check_mix(docs, budget=1000, entropy=0.99, limit=1.3)
    assert rows_of(entry.queries()["op2_temperature_mixing"](spark, SF).select("doc_id", "mix_epoch")) == sorted(
        ((r.doc_id, r.mix_epoch) for r in check_mix(docs)[0]), key=repr)


def test_mixing_uneven_and_odd_rows(spark):
    rows = [(i, "w " * (1 + i % 5), None, "big") for i in range(300)] + [(1000 + i, "w w", None, f"s{i % 3}") for i in range(20)]
    check_mix(docs_frame(spark, rows).select("doc_id", "text", "source"), entropy=0.97, limit=3.0)
    docs = odd_docs(spark)
    check_mix(docs.select("doc_id", "text", "source"))
    assert mixing.mix(with_clashes(docs)).select(*docs.columns).columns == docs.columns
    assert mixing.mix(docs.limit(0)).collect() == []
    assert mixing.mix(docs.where("text IS NULL")).count() == docs.where("text IS NULL").count()


def test_columns_of_any_name_stay(spark):
    from daypulse.llm import simhash

    docs = odd_docs(spark)
    for name in ("mix_key", "MIX_EPOCH", "mix_block", "__row", "__id", "__doc", "__rest", "__tokens", "__source_key", "__n", "root"):
        docs = docs.withColumn(name, F.concat(F.lit("own "), F.col("doc_id").cast("string")))
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "mix_epoch_2", "mix_block_2", "mix_key_2"]
    plain = Counter((r.doc_id, r.mix_epoch) for r in mixing.mix(odd_docs(spark)).collect())
    assert sum(plain.values()) and Counter(r.doc_id for r in mixed.collect()).keys() == Counter(i for i, _ in plain).keys()
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (r.doc_id for r in simhash.deduplicate(odd_docs(spark)).collect()), key=repr)
    for r in [*mixed.collect(), *kept.collect()]:
        want = None if r.doc_id is None else f"own {r.doc_id}"
        assert r["mix_key"] == r["__row"] == r["__id"] == r["root"] == want


def test_blocks_are_permuted(spark):
    frame = spark.range(4096).select(F.lit("=s").alias("s"), F.col("id").alias("b"))
    for e in (0, 1):
        k = frame.select("b", (mixing.order_key(F.col("s"), F.col("b"), F.lit(0).cast("long"), F.lit(e), 17) / (1 << 48)).cast("int").alias("k"))
        places = [r.k for r in k.orderBy("b").collect()]
        assert sorted(places) == list(range(4096)) and places != list(range(4096))


# --- vectors --------------------------------------------------------------

def brute_vectors(rows, least=0.95):
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], float) for k in (i, j))
                if (a / np.linalg.norm(a)) @ (b / np.linalg.norm(b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    root[max(top(i), top(j))] = min(top(i), top(j))
    low = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            low[top(i)] = min(v, low.get(top(i), v))
    return sorted(((v, links[i], low.get(top(i)), v == low.get(top(i))) for i, (v, _) in enumerate(rows)), key=repr)


def test_vectors_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = entry.queries()["op9_vector_dedup"](spark, SF)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert rows_of(got) == brute_vectors(rows)


@pytest.mark.parametrize("chunk", [3, 1024])
def test_vectors_clusters_and_odd_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(vector_dedup, "CHUNK", chunk)
    r = np.random.default_rng(4)
    rows = []
    for c in range(30):
        centre = r.normal(size=6)
        for _ in range(int(r.integers(1, 14))):
            rows.append((len(rows), (centre + r.normal(scale=0.25, size=6)).astype(np.float32).tolist()))
    rows += [(500, None), (501, []), (502, [0.0] * 6), (503, [float("nan")] * 6), (504, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (505, [float("inf")] * 6), (506, [1.0, 0.0, 0.0]), (507, [2.0, 0.0, 0.0]), (508, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]),
             (None, [3.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (508, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (509, [1e-30, 0.0, 0.0, 0.0, 0.0, 0.0]), (510, [-0.0, 1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vector_dedup.near_duplicates(with_clashes(frame))
    want = brute_vectors([(i, None if v is None else [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    assert rows_of(got) == want
    assert sum(w[1] > 0 for w in want) > 50
    assert vector_dedup.near_duplicates(frame.limit(0)).collect() == []


def test_vectors_in_a_dense_cell(spark):
    """Thousands of like vectors beside scattered ones: every link counts."""
    r = np.random.default_rng(8)
    centre = r.normal(size=16)
    x = np.vstack([centre + r.normal(scale=s, size=(n, 16)) for s, n in ((0.2, 1_600), (0.35, 900))]
                  + [r.normal(size=(1_500, 16))]).astype(np.float32)
    ids = r.permutation(len(x))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    close = unit @ unit.T
    near = close >= 0.95
    sure = np.abs(close - 0.95).min(1) > 1e-12  # rows without a cosine at the very limit
    np.fill_diagonal(near, False)
    root, left = np.full(len(x), -1), set(range(len(x)))
    while left:
        group, edge = set(), {left.pop()}
        while edge:
            group |= edge
            edge = set(np.flatnonzero(near[list(edge)].any(0)).tolist()) - group
        left -= group
        root[list(group)] = min(ids[list(group)])
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = {g.vec_id: g for g in vector_dedup.near_duplicates(frame).collect()}
    assert near.sum() > 500_000 and sure.all()
    for i, vec in enumerate(ids.tolist()):
        assert (got[vec].n_links, got[vec].component_id, got[vec].kept) == (near[i].sum(), root[i], vec == root[i])


# --- the pipeline ---------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, at, SF)
        assert out.columns == docs.columns
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= {r.doc_id for r in at.select("doc_id").collect()}
        at = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "simhash_dedup", "mixing", "packing"]


def test_pipeline_run_equals_its_stages_by_brute_force(spark):
    from test_simhash import brute
    from test_tokens_packing import check_packing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality_filter(spark, corpus_pipeline.language(spark, docs, SF), SF)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    once = {i for i, _, c in brute(rows) if i == c}
    deduplicated = corpus_pipeline.near_duplicates(spark, kept, SF)
    assert sorted(r.doc_id for r in deduplicated.collect()) == sorted(once)
    mixed = corpus_pipeline.mixture(spark, deduplicated, SF)
    check_packing(mixed, entry.queries()["pipeline"](spark, SF))


def test_pipeline_odd_rows(spark):
    at = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
    assert at.count() > 0
    at = odd_docs(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
        assert at.count() == 0
