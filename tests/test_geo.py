"""J1 range lookup: overlap rule, unknown, null ip; broadcast == bucketed."""

import random

from daypulse.functions.net import ip_to_long
from daypulse.operators import geo

RANGES = "start_ip bigint, end_ip bigint, country string, local_city string"


def _ip(n):
    return ".".join(str((n >> s) & 255) for s in (24, 16, 8, 0))


def _lookup(spark, ranges, ips, strategy, bits=16):
    r = spark.createDataFrame(ranges, RANGES)
    i = spark.createDataFrame([(x,) for x in ips], "_ip string")
    return {row._ip: row._location for row in geo.locate_ips(i, r, strategy, bits).collect()}


def test_overlap_greatest_start_wins(spark):
    ranges = [(0, 100, "A", "a"), (50, 60, "B", "b")]
    for strategy in ("broadcast", "bucketed"):
        got = _lookup(spark, ranges, [_ip(55), _ip(70), _ip(101), "junk", None], strategy)
        assert got == {_ip(55): "B b", _ip(70): "A a", _ip(101): "unknown",
                       "junk": "A a", None: "A a"}  # malformed/null ip -> 0


def test_with_location_keeps_every_fact_row(spark):
    r = spark.createDataFrame([(16909056, 16909311, "X", "y")], RANGES)
    facts = spark.createDataFrame([(1, "1.2.3.4"), (2, "1.2.3.4"), (3, "9.9.9.9"), (4, None)],
                                  "id int, ip string")
    out = {x.id: x.loc for x in geo.with_location(facts, r, "ip", "loc").collect()}
    assert out == {1: "X y", 2: "X y", 3: "unknown", 4: "unknown"}


def test_broadcast_equals_bucketed_random(spark):
    rnd = random.Random(11)
    ranges = []
    for _ in range(40):
        start = rnd.randrange(0, 2**32 - 2**22)
        ranges.append((start, start + rnd.randrange(0, 2**22), f"c{rnd.randrange(5)}", f"l{rnd.randrange(9)}"))
    ips = [_ip(rnd.randrange(0, 2**32)) for _ in range(300)]
    ips += [_ip(s + rnd.randrange(0, e - s + 1)) for s, e, _, _ in ranges]
    a = _lookup(spark, ranges, ips, "broadcast")
    b = _lookup(spark, ranges, ips, "bucketed", bits=16)
    c = _lookup(spark, ranges, ips, "bucketed", bits=20)
    assert a == b == c
    # brute force
    for ip in ips:
        n = sum(int(p) << s for p, s in zip(ip.split("."), (24, 16, 8, 0)))
        hits = [(s, -e, f"{c} {l}") for s, e, c, l in ranges if s <= n <= e]
        assert a[ip] == (max(hits)[2] if hits else "unknown")


def test_disjoint_pieces_equal_the_lookups(spark):
    rnd = random.Random(5)
    for bits in (4, 16):
        ranges = [(0, 2**12, "W", "all"), (7, 7, "one", "x"), (7, 7, "one", "y"), (5, 2, "bad", ""), (None, 3, "bad", "")]
        for _ in range(30):
            start = rnd.randrange(0, 2**12)
            ranges.append((start, start + rnd.randrange(0, 300), f"c{rnd.randrange(5)}", f"l{rnd.randrange(9)}"))
        r = spark.createDataFrame(ranges, RANGES)
        ips = [(n, _ip(n)) for n in range(0, 2**12 + 320, 3)] + [(-1, "junk"), (-2, None), (-3, _ip(2**32 - 1)), (-4, _ip(7))] * 2
        facts = spark.createDataFrame(ips, "id long, ip string")
        a = geo.with_location(facts, r, "ip", "loc", strategy="bucketed", bucket_bits=bits)
        b = geo.with_location(facts, r, "ip", "loc", strategy="disjoint", bucket_bits=bits)
        assert a.columns == b.columns and sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr)
        pieces = sorted((p._lo, p._hi) for p in geo.disjoint_ranges(r, bits).collect())
        assert all(lo <= hi for lo, hi in pieces) and all(x[1] < y[0] for x, y in zip(pieces, pieces[1:]))
    none = spark.createDataFrame([], RANGES)
    assert {x.loc for x in geo.with_location(facts, none, "ip", "loc", strategy="disjoint").collect()} == {"unknown"}


def test_ip_number_matches(spark):
    df = spark.createDataFrame([("10.0.0.1",)], "ip string")
    assert df.select(ip_to_long("ip")).collect()[0][0] == 167772161
