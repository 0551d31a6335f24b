"""Ops 3, 4, 7, 12 and 13 against their DuckDB SQL on the tables and on odd rows."""

import duckdb
import pytest
from helpers import odd_docs, rows_of, with_clashes

import __spark_entry__ as entry
from daypulse.llm import hamming_search, license_scan, url_filter
from daypulse.llm import oracles

SF = "/root/testdata/sf0.001"


def oracle(name, **tables):
    con = duckdb.connect()
    for table in ("pages", "documents", "embeddings", "conversations"):
        con.execute(f"CREATE TABLE {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    for table, rows in tables.items():
        con.execute(f"DELETE FROM {table}")
        for r in rows:
            con.execute(f"INSERT INTO {table} VALUES ({', '.join('?' * len(r))})", list(r))
    cur = con.execute(oracles.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    return names, sorted(cur.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = entry.queries()[name](spark, SF)
    names, want = oracle(name)
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.select(*names)) == want


PAGES = [(1, None), (2, ""), (3, "no scheme.net/"), (4, "HTTP://Example.NET/en/x"), (5, "http://a.b.example.net/en/"),
         (6, "http://example.net"), (7, "http://example.net?x=/en/"), (8, "http://notexample.net/en/"), (9, "https://x.org/fr/#a"),
         (10, "https://x.org/fr"), (11, "https://ÄX.Example.com/de/ü?q"), (12, "ftp://example.com/DE/"), (None, "http://q.com/1"),
         (13, "http://q.com/1"), (13, "http://q.com/1"), (14, "http://" + "long" * 3000 + ".com/😀"), (15, "x://://y"), (16, "://net/")]


def test_url_odd_rows(spark):
    rows = PAGES + [(100 + i, f"http://h{i % 7}.{d}{p}{i}") for i in range(60)
                    for d, p in (("net", "/a/"), ("org", "/fr/"), ("com", "/b/"), ("example.com", "/de/"))]
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in rows], "page_id long, url string, html string")
    got = url_filter.judge(with_clashes(pages).withColumnRenamed("n", "label"))
    names, want = oracle("op3_url_language_model", pages=[(i, u, "<p>") for i, u in rows])
    assert rows_of(got.select(*names)) == want
    by = {r.page_id: r for r in got.collect()}
    assert (by[4].host, by[4].path, by[4].rule, by[4].verdict) == ("example.net", "/en/x", "example.net/en/", "allow")
    assert by[6].rule is None and by[8].rule == "net/" and by[9].rule == "org/fr/" and by[10].rule is None
    assert (by[3].host, by[3].path) == ("", "") and by[1].verdict == "allow" and by[1].score is None
    assert len({r.verdict for r in got.collect() if r.rule is None}) == 2


def test_url_one_class_or_none(spark):
    for rows in ([(1, "http://a.net/x"), (2, "http://b.com/")], [(2, "http://b.com/")], []):
        pages = spark.createDataFrame([(i, u, "") for i, u in rows], "page_id long, url string, html string")
        names, want = oracle("op3_url_language_model", pages=[(i, u, "") for i, u in rows])
        assert rows_of(url_filter.judge(pages).select(*names)) == want


TEXTS = ["Released under the MIT License.", "under THE mit-license under the mit license", "cc by nc cc by nc cc", "CC BY-NC 4.0",
         "Apache License, Version 2.0", "x. This work is licensed under the GNU General Public License, version 3. y",
         "This work is licensed under the gnu public licence version 3", "permission is hereby granted, free of charge, to any person\n"
         "obtaining a copy", "é under the mit license", "under\u00e9 the mit license", "under the mit licenses", "cc\n\nby\tnc", ""]


def test_license_odd_rows(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in odd_docs(spark).collect()]
    rows += [(100 + i, t, None, None, None) for i, t in enumerate(TEXTS + TEXTS[:2])] + [(100, TEXTS[5], None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = license_scan.scan(with_clashes(docs))
    names, want = oracle("op7_license_scan", documents=rows)
    assert rows_of(got.select(*names)) == want
    by = {r.doc_id: r for r in got.collect() if r.doc_id not in (100, None)}
    assert (by[101].n_base, by[101].first_word, by[101].last_word) == (2, 0, 4)
    assert by[102].n_base == 2 and by[105].labels == "gpl-3" and by[105].base_labels == "" and by[105].score == 1.0
    assert 0.8 <= by[106].score < 1 and by[109].n_base == 0 and by[111].base_labels == "cc-by-nc"
    assert license_scan.scan(docs.limit(0)).collect() == []


VECTORS = [(0, None), (50, [1.0] * 64), (100, [float("nan")] * 64), (150, [0.5, None, -1.0]), (200, []), (3, [1.0] * 64),
           (4, [-1.0] * 64), (None, [1.0] * 64), (50, [1.0] * 64), (7, [1.0] * 63 + [-1.0]), (250, [1.0] * 90)]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_hamming_odd_rows(spark, k):
    rows = VECTORS + [(1000 + i, [float((i * 7919 >> b) % 2) - 0.5 for b in range(64)]) for i in range(40)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int")
    codes = frame.selectExpr("vec_id AS id", "embedding").withColumn("code", hamming_search.sign_code(frame["embedding"]))
    got = hamming_search.top_k(with_clashes(codes), codes.where("id % 50 = 0"), k=k)
    names, want = oracle("op4_multi_index_hashing", embeddings=[(i, v, 1) for i, v in rows])
    assert rows_of(got.select(*names)) == [w for w in want if w[names.index("rank")] <= k]
    assert hamming_search.top_k(codes.limit(0), codes.where("id % 50 = 0"), k=k).collect() == []


MIT = ('Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation '
       'files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use it.')
GPL = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as "
       "published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.")
BSD = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following "
       "conditions are met:")
UNLICENSE = "This is free and unencumbered software released\ninto the public domain."


def test_license_wrapped_notices(spark):
    """Expected labels are written by hand."""
    def framed(t, mark):
        return "\n".join(mark + x for x in ["x.py", "", *t.split("\n"), "", "more"])

    cases = [(MIT, "mit"), (GPL, "gpl-3"), (BSD, "bsd-3"), (UNLICENSE, "unlicense"), (GPL.replace("\n", "\r\n"), "gpl-3"),
             (framed(MIT, "# "), "mit"), (framed(BSD, " * "), "bsd-3"), ("Some prose.\n" + UNLICENSE + " Next one.", "unlicense"),
             (MIT + "\n\n" + GPL, "gpl-3,mit"), (UNLICENSE.replace("software", "software.\n"), ""),
             ("mit " + "wort " * 40 + "\nLicensed under the Apache License, Version 2.0.", "apache-2"),
             (BSD.replace("\n", "\n\n"), ""), (BSD.replace("\n", "\r\n\r\n"), ""), (BSD.replace("\n", "\n # \n"), "")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(docs).collect()}
    assert {i: got[i][0] for i in got} == {i: want for i, (_, want) in enumerate(cases)}
    assert all(got[i][1] >= 0.8 for i, (_, want) in enumerate(cases) if want)


def test_license_notices_at_every_width(spark):
    """No line length keeps a notice from being found, nor does one long line in it."""
    import textwrap

    plain = [(" ".join(t.split()), want) for t, want in ((MIT, "mit"), (GPL, "gpl-3"), (BSD, "bsd-3"), (UNLICENSE, "unlicense"))]
    rows = [(f"{want}-{n}", "x.py\n\n" + "\n".join(textwrap.wrap(t, n)) + "\n\nmore\n") for t, want in plain for n in range(40, 401, 9)]
    rows += [(f"{want}-one-{k}", "\n".join([*w[:k], " ".join(w[k:k + 4]), *w[k + 4:]]))
             for t, want in plain for w in [textwrap.wrap(t, 25)] for k in range(len(w))]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan(docs).collect()}
    assert got == {i: i.rsplit("-one", 1)[0] if "-one" in i else i.rsplit("-", 1)[0] for i, _ in rows}
    names, want = oracle("op7_license_scan", documents=[(n, t, None, None, None) for n, (_, t) in enumerate(rows)])
    sql = {w[names.index("doc_id")]: w[names.index("labels")] for w in want}
    assert {i: got[i] for i, _ in rows} == {i: sql[n] for n, (i, _) in enumerate(rows)}


def test_hamming_dense_cluster_moves_few_rows(spark, monkeypatch):
    """A third of all codes share segment values: each pair passes once, and
    the hits that are kept are at most k a query."""
    import random

    r = random.Random(6)
    base = r.getrandbits(64)
    codes = [base ^ r.getrandbits(20) for _ in range(400)] + [r.getrandbits(64) for _ in range(800)]
    codes = [c - 2**64 if c >= 2**63 else c for c in codes]
    frame = spark.createDataFrame(list(enumerate(codes)), "id long, code long")
    seen, best = [], hamming_search._best

    def counted(found, k):
        seen.append((found.count(), found.select("qcode", "code").distinct().count()))
        out = best(found, k)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan  # before the shuffle
        return out

    monkeypatch.setattr(hamming_search, "_best", counted)
    got = rows_of(hamming_search.top_k(frame, frame.where("id % 50 = 0"), k=10))
    assert all(n == distinct for n, distinct in seen)
    want = []
    for q in range(0, len(codes), 50):
        near = sorted(((codes[q] ^ c) % 2**64).bit_count() * 10_000 + i for i, c in enumerate(codes))[:10]
        want += [(q, rank + 1, x % 10_000, x // 10_000) for rank, x in enumerate(near)]
    assert got == sorted(want, key=repr)
