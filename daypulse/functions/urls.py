"""URL expressions F1-F5, pure Catalyst (regex + higher-order functions).

No Python runs per row. The parse is a chain of small steps; each step is
one function of the previous columns. Two ways to apply them:

* :func:`with_url_fields` (bulk use) adds the fields to a DataFrame, one
  projection per step, so each intermediate is computed once per row
  (Catalyst does not inline an expensive alias that is used twice);
* the Column functions (:func:`clean_path`, :func:`url_steps`, …) nest the
  same steps into one expression — convenient for a single field.

Quirks kept on purpose are listed per function; they define the contract
the funnel and report numbers depend on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Step segments after which the next matched segment is
# skipped (it holds an id), and the prefix that marks the in-app browser.
SKIP_AFTER = ("talkcloud", "name")
WECHAT_PREFIX = "/wechat"
WECHAT_WORD = "wechat"
INDEX_FRAGMENT = "/index.html?#"

_PROTOCOL_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"
_HOST_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)"
_NAME_VALUE_RE = r"name//([^/]*)/"
_SEGMENT_RE = r"/([a-z][a-z,A-Z]*)/"

URL_FIELDS = ("path", "clean", "is_wechat", "steps")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lit(s: str) -> Column:
    return F.lit(s)


# ------------------------------------------------------------------ steps
def decode_url(col) -> Column:
    """percent/plus decoding; null -> ''; malformed -> input unchanged."""
    c = _c(col)
    return F.coalesce(F.try_url_decode(c), c, _lit(""))


def _proto(dec: Column) -> Column:
    return F.regexp_extract(dec, _PROTOCOL_RE, 1)


def _host(dec: Column) -> Column:
    return F.regexp_extract(dec, _HOST_RE, 1)


def _stripped(dec: Column, proto: Column, host: Column) -> Column:
    """Host, ``proto://`` and ``/index.html?#`` deleted everywhere."""
    s = F.replace(dec, host, _lit(""))
    s = F.replace(s, F.concat(proto, _lit("://")), _lit(""))
    return F.replace(s, _lit(INDEX_FRAGMENT), _lit(""))


def _path(proto: Column, stripped: Column) -> Column:
    """Decoded again; a string without ``proto://`` is not a URL: null."""
    return F.when(proto != "", decode_url(stripped))


def _with_slash(c: Column) -> Column:
    return F.concat(F.regexp_replace(c, "/\\z", ""), _lit("/"))


def _doubled(path: Column) -> Column:
    return F.replace(F.replace(_with_slash(path), _lit("/"), _lit("//")),
                     _lit(WECHAT_WORD), _lit(""))


def _names_removed(p: Column) -> Column:
    """Every value that follows a ``name`` segment is deleted everywhere."""
    names = F.regexp_extract_all(p, _lit(_NAME_VALUE_RE), F.lit(1))
    return F.aggregate(names, p, lambda acc, v: F.replace(acc, v, _lit("")))


def _steps(path: Column, p: Column) -> Column:
    segments = F.regexp_extract_all(p, _lit(_SEGMENT_RE), F.lit(1))
    start = F.struct(F.lit(False).alias("skip"), _lit("").alias("acc"))

    def step(state, seg):
        keep = F.struct(seg.isin(*SKIP_AFTER).alias("skip"),
                        F.concat(state["acc"], seg, _lit("/")).alias("acc"))
        drop = F.struct(F.lit(False).alias("skip"), state["acc"].alias("acc"))
        return F.when(state["skip"], drop).otherwise(keep)

    joined = F.aggregate(segments, start, step, lambda s: s["acc"])
    return (F.when(path.isNull(), F.lit(None).cast("string"))
            .when(p.startswith("/"), joined).otherwise(_lit("")))


def _clean(path: Column) -> Column:
    return F.when(path.startswith(WECHAT_PREFIX),
                  F.replace(path, _lit(WECHAT_PREFIX), _lit(""))).otherwise(path)


# ---------------------------------------------------------- column forms
def raw_path(col) -> Column:
    """Decoded path of a URL, before the ``/wechat`` prefix is removed.

    Decode; delete host, ``proto://`` and ``/index.html?#`` by literal
    replacement everywhere in the string; decode again. The port is not
    removed. A string without ``proto://`` is not a URL: null.
    """
    dec = decode_url(col)
    return _path(_proto(dec), _stripped(dec, _proto(dec), _host(dec)))


def is_wechat(col) -> Column:
    """the decoded path starts with ``/wechat``."""
    return raw_path(col).startswith(WECHAT_PREFIX)


def clean_path(col) -> Column:
    """decoded path; every ``/wechat`` removed if the path starts with it."""
    return _clean(raw_path(col))


def url_steps(col) -> Column:
    """the page kind of a URL, ids removed.

    Append ``/`` if missing, double every ``/``, delete ``wechat``; delete
    each value that follows a ``name`` segment everywhere; if the result
    starts with ``/`` keep the segments made of ``[a-z][a-zA-Z,]*`` joined by
    ``/``, skipping the next kept segment after ``talkcloud`` or ``name``.
    """
    path = raw_path(col)
    return _steps(path, _names_removed(_doubled(path)))


def path_param(path, name: str) -> Column:
    """value ``v`` of the first ``/name/v/``, with ``name`` removed from it;
    ``''`` when there is none."""
    value = F.regexp_extract(_with_slash(_c(path)), "/\\Q" + name + "\\E/([^/]*)/", 1)
    return F.replace(value, _lit(name), _lit(""))


# ------------------------------------------------------------- bulk form
def with_url_fields(df: DataFrame, url_col: str = "url", fields=URL_FIELDS,
                    prefix: str = "", urls_only: bool = False) -> DataFrame:
    """Add ``path`` (decoded, /wechat kept), ``clean`` (F2), ``is_wechat``
    (F3) and ``steps`` (F4) — or the subset in ``fields`` — computing every
    intermediate once per row.

    ``urls_only`` drops rows that are not URLs (null path) with a cheap
    test on the protocol, before the expensive steps: a filter on a derived
    column would be pushed below the projections with the whole expression
    inlined into it."""
    tmp = ["_u_dec", "_u_proto", "_u_host", "_u_stripped", "_u_path", "_u_p0", "_u_p1"]
    out = df.withColumn("_u_dec", decode_url(url_col))
    out = out.withColumns({"_u_proto": _proto(F.col("_u_dec")), "_u_host": _host(F.col("_u_dec"))})
    if urls_only:
        out = out.filter(F.col("_u_proto") != "")
    out = out.withColumn("_u_stripped", _stripped(F.col("_u_dec"), F.col("_u_proto"), F.col("_u_host")))
    out = out.withColumn("_u_path", _path(F.col("_u_proto"), F.col("_u_stripped")))
    path = F.col("_u_path")
    cols = {}
    if "steps" in fields:
        out = out.withColumn("_u_p0", _doubled(path))
        out = out.withColumn("_u_p1", _names_removed(F.col("_u_p0")))
        cols[prefix + "steps"] = _steps(path, F.col("_u_p1"))
    if "path" in fields:
        cols[prefix + "path"] = path
    if "clean" in fields:
        cols[prefix + "clean"] = _clean(path)
    if "is_wechat" in fields:
        cols[prefix + "is_wechat"] = path.startswith(WECHAT_PREFIX)
    return out.withColumns(cols).drop(*[c for c in tmp if c in out.columns])
