"""Token ids, token files and packing against the plain tokenizer."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import odd_docs, rows_of, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from daypulse.llm import packing, token_files
from daypulse.llm.storage import scratch_path
from daypulse.llm.tokens import default_tokenizer, encoder

SF = "/root/testdata/sf0.001"
BITS = ["a", "b ", "don't", " ", "  ", "\n", ".", "é", "ß,", "漢字", "'s", "_", "!!", "\t", "\x1c", "\x85", " 12", "<|endoftext|>",
        "Word.\nNext", "x\n\ny", " ", "#$%"]


def plain(text):
    return encoder(default_tokenizer()).whole.encode(text or "", add_special_tokens=False).ids


def fast(texts):
    out = []
    for at, ids, ends in encoder(default_tokenizer()).batches(pa.array(texts, pa.string())):
        assert at == len(out)
        out += [ids[i:j].tolist() for i, j in zip(ends[:-1], ends[1:])]
    return out


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(BITS), max_size=12).map("".join) | st.text(max_size=20) | st.none(), max_size=6))
def test_ids_equal_the_tokenizers(texts):
    assert fast(texts) == [plain(t) for t in texts]


def test_long_text_and_long_piece():
    texts = ["a" * 5_000 + "'", "word, " * 20_000]
    assert fast(texts) == [plain(t) for t in texts]


def check_files(docs, got):
    want, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")):
        ids = plain(r.text) + [0]
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert rows_of(got) == sorted(want, key=repr)


def test_token_files_query(spark):
    got = entry.queries()["op6_token_files"](spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    check_files(spark.read.parquet(f"{SF}/documents.parquet"), got)


def test_token_files_odd_rows_and_layout(spark):
    docs = odd_docs(spark)
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(with_clashes(docs), path)
    check_files(docs, token_files.digest(spark, path))
    meta = token_files.read_tokens(spark, path, ["doc_id", "n_tokens"])
    plan = meta._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan.replace("n_tokens", "")  # metadata alone is read
    import glob

    import pyarrow.parquet as pq

    name = max(glob.glob(path.removeprefix("file:") + "/*.parquet"), key=lambda f: pq.read_metadata(f).num_rows)
    found = pq.read_metadata(name)
    assert found.num_rows
    group = found.row_group(0)
    encodings = {group.column(k).path_in_schema: set(group.column(k).encodings) for k in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in encodings["doc_id"]
    assert encodings["tokens.list.element"] & {"RLE_DICTIONARY", "PLAIN_DICTIONARY"}
    assert group.column(0).has_offset_index and group.column(0).has_column_index
    empty = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs.limit(0), empty)
    assert rows_of(token_files.digest(spark, empty)) == []


def check_packing(docs, got, capacity=1024):
    rows = got.collect()
    texts = [plain(r.text) + [2] for r in docs.collect()]
    want = Counter()
    for r, ids in zip(docs.collect(), texts):
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
            want[(r.doc_id, k, s, e - s, crc(ids[s:e]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), sum(map(len, texts))


def test_packing_query(spark):
    got = entry.queries()["op10_best_two_fit"](spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    bins, total = check_packing(spark.read.parquet(f"{SF}/documents.parquet"), got)
    assert bins <= 1.05 * -(-total // 1024) + 1


def test_packing_odd_rows(spark):
    docs = odd_docs(spark)
    check_packing(docs, packing.pack(with_clashes(docs)))
    check_packing(docs, packing.pack(docs, capacity=7), 7)
    assert packing.pack(docs.limit(0)).collect() == []


def one_by_one(lengths, capacity):
    """Best-two-fit with no counts: one sequence after the other."""
    stock, out = sorted(lengths), []
    while stock:
        used, gap = [], capacity
        while fits := [n for n in stock if n <= gap]:
            used.append(fits[-1])
            stock.remove(fits[-1])
            gap -= fits[-1]
        small = used[-1]
        stock.append(small)
        stock.sort()
        room = gap + small
        pairs = [(a + b, b, a) for i, a in enumerate(stock) for b in stock[i + 1:] if small < a + b <= room]
        if pairs:
            most = max(p[0] for p in pairs)
            _, b, a = min((p for p in pairs if p[0] == most), key=lambda p: p[2])
            used[-1:] = [b, a]
        for n in used[-2:] if pairs else used[-1:]:
            stock.remove(n)
        out.append(tuple(used))
    return out


def test_fillings_equal_one_by_one():
    r = random.Random(2)
    for _ in range(60):
        cap = r.randrange(3, 40)
        lengths = [r.randrange(1, cap + 1) for _ in range(r.randrange(1, 120))]
        runs = packing.fillings(Counter(lengths), cap)
        assert Counter(tuple(u) for u, n in runs for _ in range(n)) == Counter(one_by_one(lengths, cap))
        assert all(sum(u) <= cap for u, _ in runs)
