"""Audits of sources: is a page a feed, which way in is best, does a target's yield look right."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import canonical_url, depth

# Paths where feeds and sitemaps usually lie, and titles that are a site's furniture.
FEED_PATHS = ["/feed", "/feed/", "/rss", "/rss.xml", "/feed.xml", "/atom.xml", "/index.xml", "/news/feed", "/news/rss", "/blog/feed", "/feeds/posts/default"]
SITEMAP_PATHS = ["/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml"]
FURNITURE = [
    "read", "read more", "more", "about us", "about", "home", "contact", "contact us", "skip to main content", "menu", "search", "log in", "login",
    "join", "subscribe", "next", "previous", "view all", "sign up", "cookies", "privacy",
]

FEW, MANY, SHORT_TITLE, DEPTHS = 3, 250, 9, 3


def looks_like_feed(status: Column, content_type: Column, body: Column) -> Column:
    head = F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 2000))
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    xml = kind.rlike("xml|rss|atom") | F.contains(head, F.lit("<?xml"))
    return F.coalesce((status == 200) & xml & head.rlike("<rss|<feed|<rdf:rdf"), F.lit(False))


def first_feed(responses: DataFrame) -> DataFrame:
    """``base, feed``: of ``base, ord, url, status, content_type, body`` the first guessed path that is a feed."""
    fine = responses.filter(looks_like_feed(F.col("status"), F.col("content_type"), F.col("body")))
    return fine.groupBy("base").agg(F.min_by("url", "ord").alias("feed"))


def sitemaps_in_robots(robots: Column) -> Column:
    return F.regexp_extract_all(robots, F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1))


def sitemap_facts(body: Column) -> Column:
    """``struct<n_urls, has_lastmod>``; null where there are no URLs."""
    low = F.lower(F.coalesce(body, F.lit("")))
    n = F.regexp_count(low, F.lit("<url>")).cast("long")
    return F.when(n > 0, F.struct(n.alias("n_urls"), F.contains(low, F.lit("<lastmod")).alias("has_lastmod")))


def tier(reachable: Column, has_feed: Column, has_dated_sitemap: Column) -> Column:
    """1: a feed; 2: a sitemap with dates; 3: neither; ?: unreachable."""
    return F.when(~reachable, "?").when(has_feed, "1").when(has_dated_sitemap, "2").otherwise("3")


def tier_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tier").agg(F.count(F.lit(1)).alias("n")).orderBy("tier")


def write(rows: DataFrame, folder: str) -> None:
    """An audit as JSON, in order of tier and organisation."""
    rows.orderBy("tier", "org").write.mode("overwrite").json(folder)


def figures(candidates: DataFrame, key: list[str]) -> DataFrame:
    """What the warnings rest on, per ``key``, of ``url, title, published_at``."""
    title = F.lower(F.trim(F.coalesce("title", F.lit(""))))
    rows = candidates.withColumn("_t", title).withColumn("_d", depth(canonical_url(F.col("url"))))
    return rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_t").isin(FURNITURE) | (F.length("_t") < SHORT_TITLE)).alias("n_junk"),
        F.countDistinct("_t").alias("n_titles"),
        F.count("published_at").alias("n_dated"),
        F.countDistinct("_d").alias("n_depths"),
    )


def warnings(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`figures` with ``warnings array<string>``."""
    rules = [
        ("few", F.col("n") < FEW),
        ("many", F.col("n") > MANY),
        ("junk_titles", F.col("n_junk") * 3 > F.col("n")),
        ("repeated_titles", F.col("n_titles") * 2 < F.col("n")),
        ("no_dates", F.col("n_dated") == 0),
        ("many_depths", F.col("n_depths") > DEPTHS),
    ]
    return rows.withColumn("warnings", F.filter(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]), lambda x: x.isNotNull()))
