"""IP addresses as numbers: F8 (dotted quad -> ``bigint``), and IPv4 and IPv6
as 128-bit addresses in two ``bigint`` halves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: IPv4 addresses lie behind this prefix of the IPv6 space (::ffff:0:0/96).
MAPPED = 0xFFFF << 32


def _c(ip) -> Column:
    return F.col(ip) if isinstance(ip, str) else ip


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _quad(text: Column) -> Column:
    """The number of a dotted quad, or null. Each of its four parts must be
    the plain text of a number up to 255."""
    def number(parts: Column) -> Column:
        plain = F.forall(parts, lambda p: F.coalesce(
            p.try_cast("bigint").between(0, 255) & (p.try_cast("bigint").cast("string") == p), F.lit(False)))
        total = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, p: acc * 256 + p.try_cast("bigint"))
        return F.when((F.size(parts) == 4) & plain, total)

    return _let(F.split(text, r"\."), number)


def ip_to_long(ip) -> Column:
    """a.b.c.d -> a*2^24 + b*2^16 + c*2^8 + d; anything else (null too) -> 0."""
    return F.coalesce(_quad(_c(ip)), F.lit(0).cast("bigint"))


def _plain_groups(text: Column) -> Column:
    """An IPv6 text with a dotted tail made two groups of it; null if the tail
    is no dotted quad."""
    at = F.length(text) - F.instr(F.reverse(text), ":") + 1  # the last colon

    def hexed(number: Column) -> Column:
        return F.concat(F.substr(text, F.lit(1), at), F.lower(F.hex(F.shiftright(number, 16))), F.lit(":"),
                        F.lower(F.hex(number.bitwiseAND(F.lit(0xFFFF)))))

    return F.when(F.instr(text, ".") == 0, text).otherwise(_let(_quad(F.substr(text, at + 1)), hexed))


def _eight(sides: Column) -> Column:
    """The eight groups of a text split at ``::``; null if there are not eight."""
    def groups(at: int) -> Column:
        side = F.get(sides, F.lit(at))
        return F.when(side == "", F.array().cast("array<string>")).otherwise(F.split(side, ":"))

    def filled(both: Column) -> Column:
        gap = 8 - F.size(both["left"]) - F.size(both["right"])
        return F.when(gap >= 1, F.concat(both["left"], F.array_repeat(F.lit("0"), gap), both["right"]))

    return (F.when(F.size(sides) == 1, groups(0))
            .when(F.size(sides) == 2, _let(F.struct(groups(0).alias("left"), groups(1).alias("right")), filled)))


def ip_to_halves(ip) -> Column:
    """An address as a struct (hi, lo) of signed 64-bit halves, or null if it
    is none. IPv4 is mapped into IPv6; ``::`` and a dotted tail are understood,
    zones and brackets are not."""
    def halves(groups: Column) -> Column:
        text = F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")

        def half(at: int) -> Column:
            return F.conv(F.substring(text, at, 16), 16, -10).cast("bigint")

        good = (F.size(groups) == 8) & F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(F.coalesce(good, F.lit(False)), F.struct(half(1).alias("hi"), half(17).alias("lo")))

    def six(text: Column) -> Column:
        return _let(_eight(F.split(_plain_groups(text), "::")), halves)

    def any_(text: Column) -> Column:
        mapped = _let(_quad(text), lambda n: F.when(n.isNotNull(), F.struct(F.lit(0).cast("bigint").alias("hi"), (n + MAPPED).alias("lo"))))
        return F.when(F.instr(text, ":") > 0, six(text)).otherwise(mapped)

    return _let(F.lower(_c(ip)), any_)


def halves_to_bits(hi: Column, lo: Column) -> Column:
    """The 128 bits of an address as text, highest first."""
    return F.concat(F.lpad(F.bin(hi), 64, "0"), F.lpad(F.bin(lo), 64, "0"))
