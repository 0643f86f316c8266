"""Extraction: what a fetched page says about an item."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash, or_else, summary, word_count

MIN_WORDS = 40
MAX_TITLE = 400


def media_type(content_type: Column, url: Column) -> Column:
    return F.when(F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("pdf")) | F.lower(url).endswith(".pdf"), F.lit("pdf")).otherwise(F.lit("html"))


def failure(status_code: Column, words: Column) -> Column:
    """Why an item fails, or null."""
    return (
        F.when(status_code.isNull(), F.lit("unreachable"))
        .when(status_code != 200, F.concat(F.lit("http "), status_code.cast("string")))
        .when(words < MIN_WORDS, F.concat(F.lit("too short ("), words.cast("string"), F.lit(" words)")))
    )


def best_title(listed: Column, og: Column, tag: Column) -> Column:
    """The listing's title, else the page's og:title, else its title element; trimmed and cut."""
    title = F.trim(or_else(listed, og, tag))
    return F.nullif(F.substring(title, 1, MAX_TITLE), F.lit(""))


def best_date(listed: Column, source: Column, page: Column, page_source: Column, first_seen: Column) -> Column:
    """``struct<day, source>``: a page's date replaces none or a sitemap's; without any the day of the first sight."""
    from_page = page.isNotNull() & (source.isNull() | (source == "sitemap"))
    day = F.when(from_page, page).otherwise(listed)
    where = F.when(from_page, page_source).otherwise(source)
    return F.struct(F.coalesce(day, F.to_date(first_seen)).alias("day"), F.when(day.isNull(), F.lit("first_seen")).otherwise(where).alias("source"))


def extract(items: DataFrame, pages: DataFrame, now: datetime, limit: int | None = None) -> DataFrame:
    """Discovered items with what ``pages(id, status_code, text, title, og_title, page_date, page_date_source, media_type)`` holds.

    Extracted ones lose their error, failed ones keep all but status and error; ``duplicate_of`` stays as it was. ``limit`` takes the smallest ids.
    """
    work = items.filter("status = 'discovered'")
    if limit is not None:
        work = work.orderBy("id").limit(limit)
    own = pages.select("id", *[F.col(c).alias(f"_{c}") for c in pages.columns if c != "id"])
    joined = work.join(own, "id", "left")
    words = word_count(F.col("_text"))
    error = failure(F.col("_status_code"), words)
    when = best_date(F.col("published_at"), F.col("date_source"), F.col("_page_date"), F.col("_page_date_source"), F.col("first_seen"))
    new = {
        "title": best_title(F.col("title"), F.col("_og_title"), F.col("_title")),
        "published_at": when["day"],
        "date_source": when["source"],
        "body_text": F.col("_text"),
        "summary": summary(F.col("_text")),
        "word_count": words,
        "content_hash": content_hash(F.col("_text")),
        "media_type": F.col("_media_type"),
        "last_seen": F.lit(now),
    }
    fine = F.col("_error").isNull()
    kinds = dict(items.dtypes)
    out = joined.withColumn("_error", error)
    out = out.select(
        *[
            F.when(fine, new[c]).otherwise(F.col(c)).cast(kinds[c]).alias(c)
            if c in new
            else F.when(fine, F.lit("extracted")).otherwise(F.lit("failed")).alias(c)
            if c == "status"
            else F.col("_error").alias(c)
            if c == "error"
            else F.col(c)
            for c in items.columns
        ]
    )
    return items.join(work.select("id"), "id", "left_anti").select(*items.columns).unionByName(out)
