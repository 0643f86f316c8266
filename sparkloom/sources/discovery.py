"""Discovery from the catalogue: each target's address is fetched politely and read by the target's method."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, timedelta
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import absolute, host
from ..operators.discover import first_of_each, pages_until_cutoff
from ..plans.cuts import cut
from . import api, catalogue, feeds, pages, selectors
from .fetch import PAUSE, Transport, fetch_all

#: What tells a target, and what is known of a candidate.
TARGET = ["source_ord", "target_ord", "source_id", "target"]
CANDIDATE = [*TARGET, "cand_ord", "url", "title", "published_at", "date_source", "author", "pub_content_type", "pub_topics", "content_type", "topics"]


def allowed(url: Column, include: Column, exclude: Column) -> Column:
    """Whether some of the row's own ``include`` patterns, if it has any, and none of its ``exclude`` patterns occur in the URL."""
    none = F.array().cast("array<string>")
    wanted, unwanted = F.coalesce(include, none), F.coalesce(exclude, none)
    return ((F.size(wanted) == 0) | F.exists(wanted, lambda p: F.contains(url, p))) & ~F.exists(unwanted, lambda p: F.contains(url, p))


def _from_lists(fetched: DataFrame) -> DataFrame:
    """Links of list pages by each row's selector; a target without one yields nothing."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for s, t, selector, raw in zip(frame["source_ord"], frame["target_ord"], frame["item_selector"], frame["body"]):
                rows += [(s, t, k, href, title) for k, href, title in pages.listed(raw, selector)]
            yield pd.DataFrame(rows, columns=["source_ord", "target_ord", "cand_ord", "href", "title"])

    own = fetched.filter("item_selector IS NOT NULL")
    found = own.select("source_ord", "target_ord", "item_selector", "body").mapInPandas(run, "source_ord int, target_ord int, cand_ord int, href string, title string")
    rows = found.join(own.drop("body", "title"), ["source_ord", "target_ord"]).withColumn("url", absolute("final_url", "href"))
    rows = rows.filter(F.col("url").isNotNull() & (host(F.col("url")) == host(F.col("address"))) & allowed(F.col("url"), F.col("include_patterns"), F.col("exclude_patterns")))
    return first_of_each(rows.withColumn("_k", F.struct("source_ord", "target_ord", "url")), "_k", ["cand_ord"]).drop("_k")


def _from_sitemaps(fetched: DataFrame, transport: Transport, pause: float) -> DataFrame:
    """Pages of sitemaps, those of an index through its children, one level deep."""
    plain = fetched.filter(~feeds.is_index(F.col("body")))
    index = fetched.filter(feeds.is_index(F.col("body"))).withColumn("address", F.explode(feeds.index_children(F.col("body")))).drop("body")
    inner = index.join(fetch_all(index.select(F.col("address").alias("url")).distinct(), transport, pause).select(F.col("url").alias("address"), "body"), "address").filter("body IS NOT NULL")
    rows = feeds.sitemap_urls(plain.unionByName(inner.select(*plain.columns)))
    return rows.filter(allowed(F.col("url"), F.col("include_patterns"), F.col("exclude_patterns")))


def _from_api(spark, target: dict[str, Any], ask: Callable[[dict[str, Any]], tuple[int, str]], as_of: date) -> DataFrame:  # noqa: ANN001
    """Candidates of a paged JSON API, as far as the first page that is older than the target's ``days_back``. A host's pages are asked for in one task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [row for page in frame["page"] for row in api.live(target, ask, int(page))]
            yield pd.DataFrame(rows, columns=["page", "ord", "row"])

    first = int(target.get("first_page") or 0)
    numbers = spark.range(first, first + int(target.get("pages") or 1), numPartitions=1).select(F.col("id").cast("int").alias("page"))
    rows = cut(numbers.mapInPandas(run, "page int, ord int, row string"), "api")
    if target.get("days_back") and target.get("date_field"):
        days = api.dated(rows, target, as_of)
        kept = pages_until_cutoff(days, as_of - timedelta(days=int(target["days_back"]))).select("page", "ord")
        rows = rows.join(kept, ["page", "ord"])
    return api.candidates(rows, target, as_of).withColumn("cand_ord", F.col("page") * 100_000 + F.col("ord"))


def discover(
    sources: list[dict[str, Any]], transport: Transport, as_of: date, ask: Callable[[dict[str, Any]], tuple[int, str]] | None = None, *, spark, pause: float = PAUSE
) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    """Candidates of all targets of ``sources`` (:func:`.catalogue.load_sources`), and the targets themselves for the log, ``source_id, target``.

    A target that cannot be reached or read, or whose method nothing serves, yields no candidates; :func:`~sparkloom.operators.discover.target_log`
    counts it as failed. A selector that is not understood is an error at once. JSON APIs need ``ask`` (a request to status and text).
    """
    for source in sources:
        for target in source["targets"]:
            if target.get("method") not in catalogue.METHODS:
                continue
            if target["method"] == "html" and target.get("item_selector"):
                selectors.parse(target["item_selector"])
    every = catalogue.targets(spark, sources).withColumnRenamed("id", "source_id").withColumnRenamed("name", "target").withColumnRenamed("url", "address")
    asked = every.filter(F.col("method").isin("rss", "sitemap", "html"))
    got = fetch_all(asked.select(F.col("address").alias("url")).distinct(), transport, pause)
    got = cut(got.filter("status_code = 200 AND body IS NOT NULL").select(F.col("url").alias("address"), "body", "final_url"), "fetched")
    own = asked.select(*TARGET, "method", "address", "item_selector", "include_patterns", "exclude_patterns").join(got, "address")
    by_method = lambda m: own.filter(F.col("method") == m).drop("method")
    found = [feeds.feed_entries(by_method("rss")), _from_sitemaps(by_method("sitemap"), transport, pause), _from_lists(by_method("html"))]
    for s, source in enumerate(sources):
        for t, target in enumerate(source["targets"]):  # the catalogue bounds these
            if target.get("method") == "json" and ask is not None:
                rows = _from_api(spark, target, ask, as_of)
                found.append(rows.withColumns({"source_ord": F.lit(s), "target_ord": F.lit(t), "source_id": F.lit(source["id"]), "target": F.lit(target.get("name"))}))
    types = {"published_at": "date", "pub_topics": "array<string>", "topics": "array<string>", "source_ord": "int", "target_ord": "int", "cand_ord": "int"}
    shaped = [f.select(*[(F.col(c) if c in f.columns else F.lit(None)).cast(types.get(c, "string")).alias(c) for c in CANDIDATE]) for f in found]
    out = shaped[0]
    for f in shaped[1:]:
        out = out.unionByName(f)
    return cut(out, "candidates"), every.select("source_id", "target")
