"""URL columns: normalise, scheme, host key, robots path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CRAWLABLE_SCHEMES = ("http", "https")

# Unicode white space plus the four ASCII separators that Python's strip() also cuts.
_SPACE = r"[\s\x1c-\x1f]"

_EMPTY_QUERY = r"\A([^?]*)\?\z"


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends (Spark's trim only cuts blanks)."""
    return F.regexp_replace(text, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"\A([A-Za-z][A-Za-z0-9+.-]*):", 1))


def normalize_url(url: Column) -> Column:
    """Trim and drop the fragment; case, slashes and query stay as they are.

    Only where a fragment was cut, the scheme is lower-cased and an empty query goes too.
    """
    trimmed = strip(url)
    bare = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(trimmed, r"(?s)#.*\z", ""), r"[\t\r\n]", ""), _EMPTY_QUERY, "$1"
    )
    prefix = F.regexp_extract(bare, r"\A([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    rest = bare.substr(F.length(prefix) + F.lit(1), F.length(bare))
    defragged = F.concat(F.lower(prefix), rest)
    return F.when(F.contains(trimmed, F.lit("#")), defragged).otherwise(trimmed)


def is_crawlable(url: Column) -> Column:
    return scheme(url).isin(*CRAWLABLE_SCHEMES)


def host_key(url: Column) -> Column:
    """``scheme://netloc``, the unit robots rules belong to."""
    return F.concat(scheme(url), F.lit("://"), F.regexp_extract(url, r"\A[^:/?#]+://([^/?#]*)", 1))


def site_root(url: Column) -> Column:
    return F.concat(host_key(url), F.lit("/"))


def unquote(text: Column) -> Column:
    """Percent-decode; a ``%`` without two hex digits is kept."""
    safe = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))


def quote(text: Column) -> Column:
    """Percent-encode all but ASCII letters, digits and ``_.-~/``."""
    encoded = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def _comparable(path: Column) -> Column:
    # An empty fragment, then an empty query, leaves no trace in a re-joined URL.
    return quote(F.regexp_replace(F.regexp_replace(path, r"#\z", ""), _EMPTY_QUERY, "$1"))


def robots_rule_path(raw: Column) -> Column:
    return _comparable(unquote(raw))


def robots_url_path(url: Column) -> Column:
    """Path with query, in the escaped form robots rules are compared in; never empty."""
    after_host = F.regexp_replace(unquote(url), r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    path = _comparable(after_host)
    return F.when(path == "", "/").otherwise(path)
