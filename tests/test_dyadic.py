"""J1 by aligned prefixes: the cover itself, overlaps, /0, IPv6, odd input."""

import ipaddress
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daypulse.functions.net import MAPPED, ip_to_halves
from daypulse.operators import dyadic, geo

ADDRESSES = ["1.2.3.4", "0.0.0.0", "255.255.255.255", "::", "::1", "2001:DB8::ff:1", "::ffff:1.2.3.4", "1:2:3:4:5:6:7:8", "1::",
             "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "64:ff9b::192.0.2.33", "1:2:3:4:5:6:1.2.3.4"]
WRONG = ["1::2::3", ":1", "1.2.3", "01.2.3.4", None, "", "g::", "1:2:3:4:5:6:7:8:9", "::1.2.3.400", "1.2.3.4::", "12345::", "1.2.3.4.",
         "+1.2.3.4", "fe80::1%eth0", "[::1]", "::1.2.3", " 1.2.3.4"]


def number(text):
    at = ipaddress.ip_address(text)
    return int(at) + (MAPPED if at.version == 4 else 0)


def halves(n):
    return tuple(h - 2**64 if h >= 2**63 else h for h in (n >> 64, n % 2**64))


def test_addresses(spark):
    df = spark.createDataFrame([(a,) for a in ADDRESSES + WRONG], "ip string")
    got = {r.ip: r.h and tuple(r.h) for r in df.select("ip", ip_to_halves("ip").alias("h")).collect()}
    assert got == {**{a: halves(number(a)) for a in ADDRESSES}, **dict.fromkeys(WRONG)}


RANGES = "start_hi long, start_lo long, end_hi long, end_lo long, country string, local_city string"


def as_range(lo, hi, country="C", city="c"):
    return (*halves(lo), *halves(hi), country, city)


def covers(spark, ranges):
    """The blocks of each range, as (first, last) addresses."""
    rows = dyadic.cover(spark.createDataFrame([as_range(a, b, str(n)) for n, (a, b) in enumerate(ranges)], RANGES)).collect()
    out = {n: [] for n in range(len(ranges))}
    for r in rows:
        first = (r.hi % 2**64 << 64) + r.lo % 2**64
        assert first % 2 ** (128 - r.len) == 0
        out[int(r.country)].append((first, first + 2 ** (128 - r.len) - 1))
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**128 - 1), st.integers(0, 128), st.integers(0, 2**128 - 1)), min_size=1, max_size=25))
def test_cover_is_exact_and_small(spark, drawn):
    ranges = [(a, min(2**128 - 1, a + d % 2**bits)) for a, bits, d in drawn] + [(9, 3), (0, 2**128 - 1), (7, 7), (0, 0), (2**127, 2**128 - 1)]
    for n, blocks in covers(spark, ranges).items():
        a, b = ranges[n]
        if a > b:
            assert blocks == []
            continue
        blocks.sort()
        assert blocks[0][0] == a and blocks[-1][1] == b and len(blocks) <= 2 * 128
        assert all(x[1] + 1 == y[0] for x, y in zip(blocks, blocks[1:]))
        # as few blocks as there can be: no two neighbours make a larger aligned one
        assert not any(y[1] - y[0] == x[1] - x[0] and x[0] % (2 * (x[1] - x[0] + 1)) == 0 for x, y in zip(blocks, blocks[1:]))


def test_number_of_blocks(spark):
    all4 = (MAPPED, MAPPED + 2**32 - 1)
    got = covers(spark, [all4, (MAPPED + 1, MAPPED + 2**32 - 2), (0, 2**128 - 1), (1, 2**128 - 2), (5, 5)])
    assert [len(got[n]) for n in range(5)] == [1, 62, 1, 254, 1]


def located(spark, ranges, ips):
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    return {r.ip: r.location for r in dyadic.locate(df, spark.createDataFrame(ranges, RANGES)).collect()}


def brute(ranges, ip):
    try:
        n = number(ip)
    except ValueError:
        return "unknown"
    hits = []
    for a, b, country, city in ranges:
        if a <= n <= b:
            hits.append((a, -b, f"{country} {city}"))
    return max(hits)[2] if hits else "unknown"


def test_overlaps_both_families_against_brute_force(spark):
    r = random.Random(12)
    ranges = [(MAPPED, MAPPED + 2**32 - 1, "World", "4"), (0x2001 << 112, (0x2002 << 112) - 1, "Six", "all"), (0, 2**128 - 1, "Z", "every")]
    for n in range(60):
        base, bits = r.choice([(MAPPED, 32), (0x2001 << 112, 112)])
        a = base + r.randrange(2**bits)
        ranges.append((a, min(base + 2**bits - 1, a + r.randrange(2 ** r.randrange(1, bits))), f"c{n % 5}", f"l{n % 7}"))
    ranges += [ranges[5][:2] + ("zz", "same"), ranges[5][:2] + ("aa", "same")]
    ips = [str(ipaddress.IPv4Address(r.randrange(2**32))) for _ in range(150)]
    ips += [str(ipaddress.IPv6Address((0x2001 << 112) + r.randrange(2**112))) for _ in range(150)]
    for a, b, *_ in ranges[3:]:
        for n in (a, b, r.randrange(a, b + 1)):
            ips.append(str(ipaddress.IPv4Address(n - MAPPED)) if MAPPED <= n < MAPPED + 2**32 else str(ipaddress.IPv6Address(n)))
    got = located(spark, [as_range(*x) for x in ranges], ips + ["junk", None])
    assert got == {**{i: brute(ranges, i) for i in ips}, "junk": "unknown", None: "unknown"}


def test_equals_the_block_form_on_ipv4(spark):
    r = random.Random(2)
    rows = [(a, min(2**32 - 1, a + r.randrange(2**22)), "c", str(n)) for n, a in enumerate(r.randrange(2**32) for _ in range(40))]
    rows += [(5, 3, "x", "y"), (-1, 5, "x", "y"), (0, 2**40, "x", "y")]
    ranges = spark.createDataFrame(rows, "start_ip long, end_ip long, country string, local_city string")
    ips = spark.createDataFrame([(str(ipaddress.IPv4Address(r.choice(rows)[0] % 2**32)),) for _ in range(60)], "_ip string")
    want = {x._ip: x._location for x in geo.locate_ips(ips, ranges).collect()}
    got = {x._ip: x.location for x in dyadic.locate(ips, dyadic.ipv4_ranges(ranges), "_ip").collect()}
    assert got == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], RANGES)
    ips = spark.createDataFrame([("1.2.3.4",)], "ip string")
    assert [tuple(x) for x in dyadic.locate(ips, none).collect()] == [("1.2.3.4", "unknown")]
    some = spark.createDataFrame([as_range(0, 5)], RANGES)
    assert dyadic.locate(ips.limit(0), some).collect() == []
    odd = spark.createDataFrame([("::", "nonsense", "c", "l"), (None, "::1", "c", "l")], "start string, end string, country string, local_city string")
    assert dyadic.text_ranges(odd).collect() == []


def test_plan_joins_by_equality(spark):
    some = spark.createDataFrame([as_range(0, 5)], RANGES)
    ips = spark.createDataFrame([("1.2.3.4",)], "ip string").withColumn("x", F.lit(1))
    plan = dyadic.locate(ips, some)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan

