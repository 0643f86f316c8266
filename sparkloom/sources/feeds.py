"""Feeds and sitemaps as candidates. Bodies come in a column; fetching is apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import free_date
from ..functions.urls import matches

CHILDREN = 20


def _tag(block: Column, name: str) -> Column:
    """The text of the first element of that name, CDATA and entities resolved; null if none or empty."""
    raw = F.regexp_extract(block, rf"(?is)<{name}(?:\s[^>]*)?>\s*(.*?)\s*</{name}\s*>", 1)
    raw = F.regexp_replace(raw, r"(?s)^<!\[CDATA\[(.*?)\]\]>$", "$1")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(entity), F.lit(char))
    return F.nullif(F.trim(raw), F.lit(""))


def feed_entries(feeds: DataFrame, body: str = "body") -> DataFrame:
    """Entries of RSS and Atom bodies: ``url, title, published_at, date_source, author``, without those that have no link.

    The date is the first of published, updated and created that parses, in the feed's own offset. Patterns do not apply to feeds.
    """
    blocks = F.regexp_extract_all(F.col(body), F.lit(r"(?is)<(?:item|entry)(?:\s[^>]*)?>.*?</(?:item|entry)\s*>"), F.lit(0))
    rows = feeds.select(*[c for c in feeds.columns if c != body], F.posexplode(blocks).alias("cand_ord", "_b"))
    b = F.col("_b")
    href = F.nullif(F.regexp_extract(b, r"(?is)<link\s[^>]*?href\s*=\s*[\"']([^\"']+)", 1), F.lit(""))
    dates = [free_date(_tag(b, n)) for n in ("pubDate", "published", "dc:date", "updated", "created")]
    author = F.coalesce(F.nullif(F.regexp_extract(b, r"(?is)<author(?:\s[^>]*)?>.*?<name>\s*(.*?)\s*</name>", 1), F.lit("")), _tag(b, "dc:creator"), _tag(b, "author"))
    rows = rows.withColumn("url", F.coalesce(_tag(b, "link"), href)).withColumn("title", _tag(b, "title")).withColumn("published_at", F.coalesce(*dates)).withColumn("author", author)
    return rows.withColumn("date_source", F.when(F.col("published_at").isNotNull(), F.lit("feed"))).filter("url IS NOT NULL").drop("_b")


def malformed(body: Column) -> Column:
    """Whether a feed is neither well-formed nor holds any entry: a failure."""
    return ~body.rlike(r"(?is)<(item|entry)[\s>]") & ~body.rlike(r"(?is)</(rss|feed|rdf:RDF)\s*>\s*$")


def is_index(body: Column) -> Column:
    return F.contains(F.lower(F.substring(body, 1, 3000)), F.lit("<sitemapindex"))


def index_children(body: Column) -> Column:
    """Addresses of an index's sitemaps, the first twenty."""
    return F.slice(F.regexp_extract_all(body, F.lit(r"(?i)<loc>\s*(.*?)\s*</loc>"), F.lit(1)), 1, CHILDREN)


def sitemap_urls(maps: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, body: str = "body") -> DataFrame:
    """Pages of sitemap bodies: ``url, published_at, date_source``; blocks are found by pattern, as broken XML must do as well."""
    blocks = F.regexp_extract_all(F.col(body), F.lit(r"(?is)<url>(.*?)</url>"), F.lit(1))
    rows = maps.select(*[c for c in maps.columns if c != body], F.posexplode(blocks).alias("cand_ord", "_b"))
    rows = rows.withColumn("url", F.nullif(F.regexp_extract("_b", r"(?i)<loc>\s*(.*?)\s*</loc>", 1), F.lit("")))
    rows = rows.filter("url IS NOT NULL").filter(matches(F.col("url"), include or [], exclude or []))
    rows = rows.withColumn("published_at", free_date(F.nullif(F.regexp_extract("_b", r"(?i)<lastmod>\s*(.*?)\s*</lastmod>", 1), F.lit(""))))
    return rows.withColumn("date_source", F.when(F.col("published_at").isNotNull(), F.lit("sitemap"))).drop("_b")


def sitemap_walk(maps: DataFrame, children: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Pages of ``maps(url, body)``, those of an index through ``children(url, body)``, one level deep; children that are missing are passed over."""
    inner = maps.filter(is_index(F.col("body"))).select(F.posexplode(index_children(F.col("body"))).alias("child_ord", "url")).join(children.select("url", "body"), "url").select("body")
    return sitemap_urls(maps.filter(~is_index(F.col("body"))).select("body").unionByName(inner), include, exclude)
