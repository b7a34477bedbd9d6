"""URL expressions as native Spark Columns (no Python worker).

Every builder here has a twin that renders the same logic as DuckDB SQL
text (``*_sql``); the twins are used only by the oracle queries that check
our Spark results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
# Tracking query keys dropped during canonicalisation (case-insensitive).
TRACKING_PARAMS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source", "spm",
)
# Tracking key prefixes dropped during canonicalisation (case-insensitive).
TRACKING_PREFIXES = ("utm_", "at_")
# URL prefixes whose pages cannot be fetched with a plain GET.
SKIP_HOST_PREFIXES = (
    "https://news.google.com/",
    "https://www.reddit.com/",
    "https://reddit.com/",
)
# ---------------------------------------------------------------------------

# RFC 3986 appendix B split: scheme, authority, path, query, fragment.
URL_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
HOST_RE = r"^https?://([^/?#]+)"


def _lit_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ----------------------------------------------------------------- Spark side
def _py_trim(c: Column) -> Column:
    # str.strip() semantics for ASCII whitespace
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _decode_component(c: Column) -> Column:
    """unquote_plus: '+' -> space, valid %XX decoded, invalid '%' kept literally."""
    escaped = F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(escaped)


def _encode_component(c: Column) -> Column:
    """quote_plus: keep [A-Za-z0-9_.~-], space -> '+', rest %XX (UTF-8)."""
    enc = F.url_encode(c)
    return F.replace(F.replace(enc, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _after_eq(p: Column) -> Column:
    return F.substr(p, F.instr(p, "=") + 1)


def canonical_url(url: Column) -> Column:
    """Canonical article URL or NULL when the URL has no scheme or host.

    Semantics: trim; lowercase scheme and the whole authority; drop the
    ``;params`` of the last path segment and the fragment; strip trailing
    slashes (empty path -> '/'); keep query pairs that have '=' and a
    non-empty value and are not tracking keys, in order, re-encoded.
    """
    u = _py_trim(url)
    scheme = F.lower(F.regexp_extract(u, URL_SPLIT, 1))
    has_authority = u.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//")
    netloc = F.lower(F.regexp_extract(u, URL_SPLIT, 2))
    path = F.regexp_extract(u, URL_SPLIT, 3)
    query = F.regexp_extract(u, URL_SPLIT, 4)
    path = F.regexp_replace(path, r";[^/]*$", "")
    path = F.regexp_replace(path, r"/+$", "")
    path = F.coalesce(F.nullif(path, F.lit("")), F.lit("/"))

    pairs = F.split(query, "&")
    kept = F.filter(
        pairs,
        # needs a '=' and a non-empty value (parse_qsl without keep_blank_values)
        lambda p: (F.instr(p, "=") > 0) & (F.length(p) > F.instr(p, "=")),
    )
    tracking = F.array(*[F.lit(t) for t in TRACKING_PARAMS])

    def is_tracking(p: Column) -> Column:
        key = F.lower(_decode_component(F.substring_index(p, "=", 1)))
        cond = F.array_contains(tracking, key)
        for prefix in TRACKING_PREFIXES:
            cond = cond | key.startswith(prefix)
        return cond

    kept = F.filter(kept, lambda p: ~is_tracking(p))
    encoded = F.transform(
        kept,
        lambda p: F.concat(
            _encode_component(_decode_component(F.substring_index(p, "=", 1))),
            F.lit("="),
            _encode_component(_decode_component(_after_eq(p))),
        ),
    )
    q = F.when(query == "", F.lit("")).otherwise(F.array_join(encoded, "&"))
    bad_brackets = (F.instr(netloc, "[") > 0) != (F.instr(netloc, "]") > 0)
    ok = (
        url.isNotNull()
        & (scheme != "")
        & has_authority
        & (netloc != "")
        & ~bad_brackets
    )
    rebuilt = F.concat(scheme, F.lit("://"), netloc, path,
                       F.coalesce(F.concat(F.lit("?"), F.nullif(q, F.lit(""))), F.lit("")))
    return F.when(ok, rebuilt)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, HOST_RE, 1)


def should_skip(url: Column) -> Column:
    cond = F.lit(False)
    for prefix in SKIP_HOST_PREFIXES:
        cond = cond | url.startswith(prefix)
    return cond


def join_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against the page URL ``base`` (absolute, scheme-relative,
    root-relative and bare relative forms)."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    base_dir = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)", 1)
    base_dir = F.when(base_dir == "", F.concat(origin, F.lit("/"))).otherwise(base_dir)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(base_dir, href))
    )


def date_from_url(url: Column) -> Column:
    """Midnight timestamp from a ``/YYYY/MM/DD/`` path part, NULL when absent/invalid."""
    pat = r"/(\d{4})/(\d{2})/(\d{2})/"
    y = F.regexp_extract(url, pat, 1)
    m = F.regexp_extract(url, pat, 2)
    d = F.regexp_extract(url, pat, 3)
    day = F.try_to_timestamp(F.concat_ws("-", y, m, d), F.lit("yyyy-MM-dd"))
    return F.when(y != "", day.cast("timestamp_ntz"))


# --------------------------------------------------------------- DuckDB twins
def _sql_decode(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _sql_encode(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def canonical_url_sql(col: str) -> str:
    u = f"regexp_replace({col}, '^\\s+|\\s+$', '', 'g')"
    split = URL_SPLIT.replace("'", "''")
    scheme = f"lower(regexp_extract({u}, '{split}', 1))"
    netloc = f"lower(regexp_extract({u}, '{split}', 2))"
    path0 = f"regexp_extract({u}, '{split}', 3)"
    query = f"regexp_extract({u}, '{split}', 4)"
    path1 = f"regexp_replace(regexp_replace({path0}, ';[^/]*$', ''), '/+$', '')"
    path = f"(CASE WHEN {path1} = '' THEN '/' ELSE {path1} END)"
    key = "lower(" + _sql_decode("split_part(p, '=', 1)") + ")"
    prefixes = " OR ".join(f"starts_with({key}, '{p}')" for p in TRACKING_PREFIXES)
    keep = (
        f"strpos(p, '=') > 0 AND length(p) > strpos(p, '=') "
        f"AND NOT ({key} IN ({_lit_list(TRACKING_PARAMS)}) OR {prefixes})"
    )
    enc = (
        _sql_encode(_sql_decode("split_part(p, '=', 1)"))
        + " || '=' || "
        + _sql_encode(_sql_decode("substr(p, strpos(p, '=') + 1)"))
    )
    q = (
        f"array_to_string(list_transform(list_filter(str_split({query}, '&'), lambda p: {keep}), "
        f"lambda p: {enc}), '&')"
    )
    has_auth = f"regexp_matches({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//')"
    bad = f"((strpos({netloc}, '[') > 0) <> (strpos({netloc}, ']') > 0))"
    ok = f"{col} IS NOT NULL AND {scheme} <> '' AND {has_auth} AND {netloc} <> '' AND NOT {bad}"
    return (
        f"(CASE WHEN {ok} THEN {scheme} || '://' || {netloc} || {path} || "
        f"(CASE WHEN coalesce({q}, '') <> '' THEN '?' || {q} ELSE '' END) END)"
    )


def url_host_sql(col: str) -> str:
    return f"regexp_extract({col}, '{HOST_RE}', 1)"


def should_skip_sql(col: str) -> str:
    return "(" + " OR ".join(f"starts_with({col}, '{p}')" for p in SKIP_HOST_PREFIXES) + ")"
