"""Search over exported items: facets, saved filters, ranking, groups by week."""

from __future__ import annotations

from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import since, week
from ..functions.jsons import any_of
from ..functions.text import occurrences
from ..plans.cuts import cut
from .discover import numbered

# The saved filters.
LENSES: dict[str, dict[str, Any]] = {
    "this_week": {"days": 7},
    "network_research": {"evidence": ["original"]},
    "digital_finance": {"topics": ["finance", "digital"]},
    "enforcement": {"content_types": ["enforcement"]},
    "policy": {"content_types": ["policy", "research"]},
    "review_queue": {"needs_review": True},
}
TITLE_WEIGHT, BODY_CAP = 12, 6
#: So many weeks, two centuries, are broadcast; more are joined.
WEEKS = 10_000


def terms_of(query: str) -> list[str]:
    """Lower-cased words of two characters or more."""
    return [t for t in query.lower().split() if len(t) > 1]


def score(terms: list[str]) -> Column:
    """Of ``title`` and ``search``: 0 unless every term occurs; 12 for a term in the title, and its places in the search text, 6 at most. 1 without terms."""
    if not terms:
        return F.lit(1).cast("long")
    total, every = F.lit(0).cast("long"), F.lit(True)
    for t in terms:
        titled, places = F.contains(F.lower(F.coalesce("title", F.lit(""))), F.lit(t)), occurrences(F.coalesce("search", F.lit("")), t)
        every = every & (titled | (places > 0))
        total = total + F.when(titled, TITLE_WEIGHT).otherwise(0) + F.least(places, F.lit(BODY_CAP))
    return F.when(every, total).otherwise(0).cast("long")


def filtered(
    items: DataFrame, query: str = "", lens: str | dict[str, Any] | None = None, org: str | None = None, content_type: str | None = None, topics: list[str] | None = None, *, as_of: date
) -> DataFrame:
    """Items that pass all facets, with ``score``. Filters come before the score, so they reach the scan."""
    f = LENSES.get(lens, {}) if isinstance(lens, str) else lens or {}
    keep = F.lit(True)
    if org:
        keep = keep & (F.col("source_id") == org)
    if content_type:
        keep = keep & (F.col("content_type") == content_type)
    if topics:
        keep = keep & any_of(F.col("topics"), topics)
    if f.get("needs_review"):
        keep = keep & F.col("needs_review")
    if f.get("content_types"):
        keep = keep & F.col("content_type").isin(f["content_types"])
    if f.get("evidence"):
        keep = keep & F.col("evidence").isin(f["evidence"])
    if f.get("topics"):
        keep = keep & any_of(F.col("topics"), f["topics"])
    if f.get("days"):
        keep = keep & since(F.col("first_seen"), f["days"], as_of)
    terms = terms_of(query)
    if not terms:
        return items.filter(keep).withColumn("score", score(terms))
    # generated, not filtered: a filter on the score would be pushed below what makes title and search text, and make them anew for each term
    return items.filter(keep).withColumn("score", F.explode(F.filter(F.array(score(terms)), lambda s: s > 0)))


def ranked(found: DataFrame) -> DataFrame:
    """Best first; ties by date and id, newest first."""
    return found.orderBy(F.col("score").desc(), F.col("published_at").desc(), F.col("id").desc())


def numbered_ranks(found: DataFrame) -> DataFrame:
    """All hits with ``rank`` from 1, in the order of :func:`ranked`; ranges of the order are numbered apart, so no task sorts them all."""
    order = [F.col("score").desc(), F.col("published_at").desc(), F.col("id").desc()]
    rows = numbered(found.withColumn("_own", F.col("id")), order, 0)
    return rows.withColumn("rank", F.col("id").cast("long")).withColumn("id", F.col("_own")).drop("_own")


def by_week(found: DataFrame, items: DataFrame) -> DataFrame:
    """Found items with their week, its number of items, and whether it is the newest of all items' weeks; newest week first."""
    rows = cut(found.withColumn("week", week(F.to_date("first_seen"))), "found")
    counts = cut(rows.groupBy("week").agg(F.count(F.lit(1)).alias("n_week")), "weeks")
    if counts.count() <= WEEKS:
        counts = F.broadcast(counts)
    newest = items.agg(week(F.max(F.to_date("first_seen"))).alias("newest"))  # one row
    out = rows.join(counts, "week").crossJoin(F.broadcast(newest)).withColumn("is_latest", F.col("week") == F.col("newest")).drop("newest")
    return out.orderBy(F.col("week").desc(), F.col("score").desc(), F.col("published_at").desc(), F.col("id").desc())


def cards(found: DataFrame) -> DataFrame:
    """What a card shows beside the item."""
    return found.select(
        "id",
        "title",
        F.when(F.length("summary") > 230, F.concat(F.substring("summary", 1, 230), F.lit("…"))).otherwise(F.col("summary")).alias("extract"),
        (F.col("date_source") == "first_seen").alias("harvested"),
        (F.col("media_type") == "pdf").alias("is_pdf"),
        F.col("updated_at").isNotNull().alias("is_updated"),
        (F.coalesce("evidence", F.lit("none")) != "none").alias("shows_evidence"),
    )
