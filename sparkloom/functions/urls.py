"""URL functions as Column expressions."""

from __future__ import annotations

from urllib.parse import urljoin

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that name a campaign, by prefix; path endings that name a folder's page.
JUNK_PREFIXES = ["utm_", "fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source", "_ga", "igshid", "s_cid"]
INDEX_PAGE = r"/index\.(html?|php|aspx)$"

#: Scheme, authority, path, query; every text matches.
_SHAPE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
_EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.regexp_replace(url, _EDGE, ""), _SHAPE, group)


def _decoded(text: Column) -> Column:
    """Form decoding; a percent sign without two hex digits stands for itself."""
    return F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(text: Column) -> Column:
    """Form encoding that keeps ``~`` and not ``*``."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(query: Column) -> Column:
    """``array<struct<k, v>>`` of a query string's parameters that have a value."""
    pieces = F.filter(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1) != p)
    pairs = F.transform(pieces, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.regexp_replace(p, "^[^=]*=", "")).alias("v")))
    return F.filter(pairs, lambda p: p["v"] != "")


def canonical_url(url: Column) -> Column:
    """One key for a document's addresses: https, no www., no :443, no index page, trailing slash, parameters of a path, fragment or campaign parameters;
    the rest of the query sorted by name and value. Null stays null."""
    host = F.lower(_part(url, 2))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), ":443$", "")
    path = F.regexp_replace(F.regexp_replace(_part(url, 3), r"^((?:.*/)?[^/;]*);[^/]*$", "$1"), INDEX_PAGE, "/")
    path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(path)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    junk = "(?i)^(" + "|".join(JUNK_PREFIXES) + ")"
    kept = F.array_sort(F.filter(query_pairs(_part(url, 4)), lambda p: ~p["k"].rlike(junk)))
    query = F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    start = F.when(host != "", F.concat(F.lit("https://"), host, F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)))).otherwise(F.concat(F.lit("https:"), path))
    return F.when(url.isNotNull(), F.concat(start, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def host(url: Column) -> Column:
    """The authority, lower-cased."""
    return F.lower(_part(url, 2))


def depth(url: Column) -> Column:
    """Number of non-empty path segments."""
    return F.size(F.filter(F.slice(F.split(url, "/"), 4, 1_000_000), lambda p: p != ""))


def matches(url: Column, include: list[str], exclude: list[str]) -> Column:
    """Whether some of ``include`` (if any are given) and none of ``exclude`` occur in the URL."""
    out = F.lit(not include)
    for p in include:
        out = out | F.contains(url, F.lit(p))
    for p in exclude:
        out = out & ~F.contains(url, F.lit(p))
    return out


def with_prefix(slug: Column, prefix: str) -> Column:
    """A slug as an address: absolute ones stay."""
    return F.when(slug.startswith("http"), slug).otherwise(F.concat(F.lit(prefix), slug))


def _absolute(base, href):  # noqa: ANN001, ANN202
    import pandas as pd

    def one(b: str | None, h: str | None) -> str | None:
        try:
            return None if b is None or h is None else urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype="object")


def absolute(base: Column | str, href: Column | str) -> Column:
    """A link's address on the page at ``base``; null where it is none."""
    return F.pandas_udf(_absolute, "string")(base, href)
