"""Sum-of-squares packing against the plain rule and the plain tokenizer."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import docs_frame, odd_docs, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from daypulse.llm import window_packing
from daypulse.llm.tokens import default_tokenizer, encoder

SF = "/root/testdata/sf0.001"
PATH = default_tokenizer("word_bpe_49k.json")
BITS = ["a", "b ", "don't", " ", "  ", "\n", ".", "é", "ß,", "漢字", "'s", "'LL", "_", "!!", "\t", "\x85", " 12", "<|endoftext|>",
        "Word.\nNext", "É", "é", "ΑΣ ", "İ", "하", "½", " ́x"]


def plain(text):
    return encoder(PATH).whole.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(BITS), max_size=12).map("".join) | st.text(max_size=20) | st.none(), max_size=6))
def test_ids_equal_the_tokenizers(texts):
    out = []
    for _, ids, ends in encoder(PATH).batches(pa.array(texts, pa.string())):
        out += [ids[i:j].tolist() for i, j in zip(ends[:-1], ends[1:])]
    assert out == [plain(t) for t in texts]


def squares(levels, capacity):
    return sum(n * n for n in Counter(h for h in levels if 0 < h < capacity).values())


def test_levels_minimise_the_sum_of_squares():
    r = random.Random(4)
    for _ in range(200):
        capacity = r.randrange(2, 24)
        levels, own = window_packing.Levels(capacity), []
        for _ in range(60):
            size = r.randrange(1, capacity + 1)
            at = levels.choose(size)
            options = {0: squares([*own, size], capacity)}
            for h in set(own):
                if h + size <= capacity:
                    rest = list(own)
                    rest.remove(h)
                    options[h] = squares([*rest, h + size], capacity)
            assert options[at] == min(options.values())
            assert at == max((h for h, v in options.items() if v == options[at]), default=0)  # ties to the fullest
            if at:
                own.remove(at)
            own.append(at + size)
            own = [h for h in own if h < capacity]
            levels.move(at, at + size)
            assert Counter(own) == {h: n for h, n in enumerate(levels.count.tolist()) if n}


def test_packer_keeps_every_id_and_bounds_what_is_open():
    r = random.Random(6)
    for capacity, most in ((8, 3), (16, 1), (64, 1000), (13, 4)):
        packer, docs, done = window_packing.Packer(capacity, most), [], []
        for key in range(300):
            ids = np.arange(r.choice([1, 2, 3, 5, capacity - 1, capacity, 3 * capacity + 2, r.randrange(1, 2 * capacity)]), dtype="<u4")
            docs.append(ids)
            done += packer.add(key, ids)
            assert packer.n_open <= most and packer.levels.count.sum() == packer.n_open
            assert all(window_packing.weight(w) == capacity for w in done)
        done += packer.end()
        assert packer.n_open == 0
        parts = {}
        for window in done:
            size = window_packing.weight(window)
            assert size == capacity or size & (size - 1) == 0
            for key, start, ids, n in window:
                assert n == len(docs[key])
                parts.setdefault(key, []).append((start, ids.tolist()))
        for key, ids in enumerate(docs):
            assert sum((p for _, p in sorted(parts[key])), []) == ids.tolist()
            assert [s for s, _ in sorted(parts[key])] == np.cumsum([0, *(len(p) for _, p in sorted(parts[key]))]).tolist()[:-1]


def check(docs, got, capacity=4096):
    rows, want = got.collect(), Counter()
    for r in docs.collect():
        want[(r.doc_id, tuple(plain(r.text) + [2]))] += 1
    by_id = {}
    for (key, ids), n in want.items():
        by_id.setdefault(key, []).append((ids, n))
    for key, texts in by_id.items():
        have = Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == key)
        assert sum(s[1] * n for s, n in have.items()) == sum(len(ids) * n for ids, n in texts)
        for (start, length, crc, total), _ in have.items():
            assert any(len(ids) == total and zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()) == crc for ids, _ in texts)
        if len(texts) == 1 and texts[0][1] == 1:  # a text of its own: its pieces follow each other
            at = 0
            for s in sorted(have):
                assert s[0] == at
                at += s[1]
            assert at == len(texts[0][0])
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    sizes = [sum(n for _, n in spans) for spans in sequences.values()]
    return sum(capacity - n for n in sizes if n & (n - 1)), sum(sizes)


def test_query(spark):
    got = entry.queries()["op11_sum_of_squares"](spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    padding, total = check(spark.read.parquet(f"{SF}/documents.parquet"), got)
    assert padding == 0 and total > 0


def test_odd_rows(spark):
    docs = odd_docs(spark)
    check(docs, window_packing.pack_windows(with_clashes(docs)))
    check(docs, window_packing.pack_windows(docs.repartition(5), capacity=8, most_open=2), 8)
    assert window_packing.pack_windows(docs.limit(0)).collect() == []
    one = docs_frame(spark, [(1, None, None, None)])
    assert [tuple(r)[:3] for r in window_packing.pack_windows(one).collect()] == [(1, 0, 1)]
