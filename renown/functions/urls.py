"""Url functions and dedup keys, as JVM-side regex / higher-order expressions.

``parse_url`` (java.net.URI) rejects urls with spaces or ``|`` and drops
ports from HOST, so urls are split with one regex instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from renown import params as P
from renown.functions.text import PY_WS, WS_CLASS, _c, let, py_strip

# scheme, authority, path, query, fragment
_URL_RE = r"(?s)^(?:([a-z][a-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# characters that form encoding keeps
_TOKEN = r"[A-Za-z0-9_.~-]+"
_NETLOC_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def to_url(col) -> Column:
    """Trim; prefix https:// unless http(s):// is there; '' without authority."""
    def body(raw):
        s = py_strip(raw)
        u = F.when(F.startswith(s, F.lit("http://")) | F.startswith(s, F.lit("https://")), s) \
             .otherwise(F.concat(F.lit("https://"), s))
        return F.when(raw.isNull() | (raw == ""), F.lit("")) \
                .when(F.regexp_extract(u, _NETLOC_RE, 1) != "", u).otherwise(F.lit(""))
    return let(col, body)


def to_domain(col) -> Column:
    """Network location (userinfo and port kept, case kept); '' if none."""
    return F.coalesce(F.regexp_extract(_c(col), _NETLOC_RE, 1), F.lit(""))


def _decode(tok: Column) -> Column:
    """Plus signs and percent escapes decoded as UTF-8; a bad escape stays, bytes that are no UTF-8 become U+FFFD."""
    def plain(t):
        parts = F.regexp_extract_all(F.replace(t, F.lit("+"), F.lit(" ")), F.lit("%[0-9A-Fa-f]{2}|[^%]+|%"), 0)
        digits = F.transform(parts, lambda x: F.when(x.rlike("^%[0-9A-Fa-f]{2}$"), F.substring(x, 2, 2)).otherwise(F.hex(x)))
        return F.make_valid_utf8(F.unhex(F.array_join(digits, "")).cast("string"))
    return F.when(tok.rlike("[%+]"), plain(tok)).otherwise(tok)


def _encode(tok: Column) -> Column:
    """Form encoding: letters, digits and ``_.-~`` stay, a space is ``+``, every other byte an upper-case escape."""
    parts = F.regexp_extract_all(tok, F.lit(f"{_TOKEN}| |[^A-Za-z0-9_.~ -]+"), 0)
    coded = F.transform(parts, lambda x: F.when(x == " ", "+").when(x.rlike("^[A-Za-z0-9_.~-]"), x)
                        .otherwise(F.regexp_replace(F.hex(x), "(..)", "%$1")))
    return F.when(tok.rlike(f"^{_TOKEN}$"), tok).otherwise(F.array_join(coded, ""))


def canonical_query(q: Column) -> Column:
    """Drop tracking params; group the rest by key in first-seen order."""
    pairs = F.filter(F.split(F.coalesce(q, F.lit("")), "&"), lambda p: p != "")
    kv = F.transform(pairs, lambda p: F.struct(
        _decode(F.substring_index(p, "=", 1)).alias("k"),
        F.when(F.contains(p, F.lit("=")),
               _decode(F.substring(p, F.locate("=", p) + 1, 1 << 30)))
         .otherwise(F.lit("")).alias("v")))
    tracking = F.array(*[F.lit(x) for x in P.TRACKING_PARAMS])
    kept = F.filter(kv, lambda e: ~F.array_contains(tracking, e["k"]))
    keys = F.array_distinct(F.transform(kept, lambda e: e["k"]))
    grouped = F.flatten(F.transform(keys, lambda k: F.transform(
        F.filter(kept, lambda e: e["k"] == k),
        lambda e: F.concat(_encode(e["k"]), F.lit("="), _encode(e["v"])))))
    return F.array_join(grouped, "&")


# the whole query is simple key[=value] tokens: nothing to decode or escape
_SIMPLE_QUERY_RE = rf"^{_TOKEN}(={_TOKEN}|=)?(&{_TOKEN}(={_TOKEN}|=)?)*$"
# some key occurs twice (then first-seen grouping may reorder values)
_REPEATED_KEY_RE = r"(?:^|&)([^=&]+)(?:=[^&]*)?&(?:.*&)?\1(?:=|&|$)"


def _simple_canonical_query(q: Column) -> Column:
    """canonical_query for simple queries with distinct keys, without higher-order functions."""
    tracking = "|".join(t.replace(".", r"\.") for t in P.TRACKING_PARAMS)
    t = F.concat(F.lit("&"), q, F.lit("&"))
    # drop tracking pairs; the lookahead keeps the separator for the next pair
    t = F.regexp_replace(t, rf"&(?:{tracking})(?:=[^&]*)?(?=&)", "")
    # a bare key has an empty value
    t = F.regexp_replace(t, r"&([^=&]+)(?=&)", "&$1=")
    return F.regexp_replace(t, r"^&+|&+$", "")


def canonical_url(col, preserve_fragment) -> Column:
    """Dedup url key: lower+strip, no tracking params, no trailing slash.

    Scheme and ``www.`` are not normalised.  The fragment is dropped unless
    ``preserve_fragment`` (a boolean Column or bool) is true.
    """
    u = py_strip(F.lower(_c(col)))
    scheme = F.regexp_extract(u, _URL_RE, 1)
    has_auth = F.regexp_extract(u, r"(?s)^(?:[a-z][a-z0-9+.\-]*:)?(//)", 1) != ""
    auth = F.regexp_extract(u, _URL_RE, 2)
    path_all = F.regexp_extract(u, _URL_RE, 3)
    query = F.regexp_extract(u, _URL_RE, 4)
    frag = F.regexp_extract(u, _URL_RE, 5)
    # params = from the first ';' after the last '/' of the path
    path = F.regexp_extract(path_all, r"(?s)^(.*?)((?:;[^/]*)?)$", 1)
    params = F.regexp_extract(path_all, r"(?s)^(.*?)((?:;[^/]*)?)$", 2)
    path = F.regexp_replace(path, "/+$", "")
    # the higher-order query rewrite only runs for queries the regex path cannot handle
    simple = query.rlike(_SIMPLE_QUERY_RE) & ~query.rlike(_REPEATED_KEY_RE)
    cq = (F.when(query == "", F.lit(""))
           .when(simple, _simple_canonical_query(query))
           .otherwise(canonical_query(query)))
    keep_frag = preserve_fragment if isinstance(preserve_fragment, Column) else F.lit(bool(preserve_fragment))
    out = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(has_auth, F.concat(F.lit("//"), auth)).otherwise(F.lit("")),
        path, params,
        F.when(cq != "", F.concat(F.lit("?"), cq)).otherwise(F.lit("")),
        F.when(keep_frag & (frag != ""), F.concat(F.lit("#"), frag)).otherwise(F.lit("")),
    )
    return F.when(_c(col).isNull() | (_c(col) == ""), F.lit("")).otherwise(out)


def canonical_title(col) -> Column:
    """Dedup title key: lower, drop non word/space chars, collapse spaces, trim."""
    t = F.regexp_replace(F.lower(F.coalesce(_c(col), F.lit(""))), rf"[^\p{{L}}\p{{N}}_{PY_WS}]", "")
    t = F.regexp_replace(t, f"{WS_CLASS}+", " ")
    return py_strip(t)
