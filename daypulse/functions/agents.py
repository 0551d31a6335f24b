"""User-agent fields F6-F7 as native regex rules (no per-row Python).

The reference parses every row with an external regex database. Here the
rules are a small ordered table applied as a ``when(rlike)`` chain;
:func:`daypulse.operators.agents.parse_user_agents` applies it to a table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "unknown"
UNKNOWN_DEVICE = "Unknown device"

# Ordered rule tables (first match wins).
# (pattern, value) — value is a literal, or None to take group 1 of pattern.
DEVICE_RULES = (
    (r"iPad", "iPad"),
    (r"iPhone", "iPhone"),
    (r"Android [0-9.]+; ([^;)]+)", None),
)
OS_RULES = (
    (r"(?:iPhone|CPU) OS ", "iOS"),
    (r"Android", "Android"),
    (r"Windows NT", "Windows"),
    (r"Mac OS X", "Mac OS X"),
    (r"Linux", "Linux"),
)
OS_MAJOR_RULES = (
    (r"OS ([0-9]+)_", None),
    (r"Android ([0-9]+)", None),
    (r"Windows NT ([0-9]+)", None),
    (r"Mac OS X ([0-9]+)", None),
)
BROWSER_RULES = (
    (r"MicroMessenger/", "WeChat"),
    (r"Edge?/", "Edge"),
    (r"Chrome/", "Chrome"),
    (r"Firefox/", "Firefox"),
    (r"Safari/", "Safari"),
    (r"curl/", "curl"),
    (r"iPhone|iPad", "Mobile Safari UI/WKWebView"),
)
OTHER = "Other"

# The tags of the two plain fields.
NET_TAG, LANGUAGE_TAG = "NetType/", "Language/"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _rule_chain(ua: Column, rules, default: str) -> Column:
    out = F.lit(default)
    for pattern, value in reversed(rules):
        hit = F.regexp_extract(ua, pattern, 1) if value is None else F.lit(value)
        out = F.when(F.coalesce(ua.rlike(pattern), F.lit(False)), hit).otherwise(out)
    return out


def _after(ua: Column, tag: str) -> Column:
    """The word behind the first ``tag``, blanks skipped; unknown without one."""
    behind = F.get(F.split(ua, tag, 2), F.lit(1))
    word = F.get(F.split(F.ltrim(behind, F.lit(" \t")), r"\s", 2), F.lit(0))
    return F.coalesce(word, F.lit(UNKNOWN))


def net_type(ua) -> Column:
    """value after ``NetType/``; ``unknown`` if absent (blank trimmed)."""
    return _after(_c(ua), NET_TAG)


def ua_language(ua) -> Column:
    """value after ``Language/``; ``unknown`` if absent."""
    return _after(_c(ua), LANGUAGE_TAG)


def device(ua) -> Column:
    return _rule_chain(_c(ua), DEVICE_RULES, UNKNOWN_DEVICE)


def os_family(ua) -> Column:
    return _rule_chain(_c(ua), OS_RULES, OTHER)


def os_version(ua) -> Column:
    """Family, a blank, and the major version or nothing."""
    return F.concat(os_family(ua), F.lit(" "), _rule_chain(_c(ua), OS_MAJOR_RULES, ""))


def browser(ua) -> Column:
    return _rule_chain(_c(ua), BROWSER_RULES, OTHER)


def ua_struct(ua) -> Column:
    """All UA fields of F6/F7 as one struct."""
    u = _c(ua)
    return F.struct(device(u).alias("device"), os_family(u).alias("os"),
                    os_version(u).alias("os_version"), ua_language(u).alias("language"),
                    net_type(u).alias("network"), browser(u).alias("browser"))
