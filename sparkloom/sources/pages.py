"""HTML pages: visible text, titles, links, dates, declared feeds. The standard library's parser runs over Arrow batches."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import BODY_DATE, sane, free_date
from ..functions.urls import absolute, host, matches
from ..operators.discover import first_of_each
from . import selectors

# Elements that are not an article's text, and where pages state their date.
DROPPED = ["script", "style", "nav", "header", "footer", "aside"]
META_DATES = [("property", "article:published_time"), ("property", "og:published_time"), ("name", "date"), ("name", "pubdate"), ("name", "DC.date.issued"), ("itemprop", "datePublished")]
JSONLD_KEYS = ["datePublished", "dateCreated", "dateModified"]
SKIPPED_LINKS = ("#", "mailto:", "tel:", "javascript:")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Reader(HTMLParser):
    """Collects in one pass what the operators here ask of a page."""

    def __init__(self, within: str | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.all_texts: list[str] = []
        self.title: list[str] = []
        self.og: str | None = None
        self.links: list[list] = []
        self.feeds: list[str] = []
        self.metas: dict[tuple[str, str], str] = {}
        self.times: list[list] = []
        self.blobs: list[str] = []
        self._within, self._open, self._dropped = selectors.parse(within) if within else None, [], 0
        self._path: list[selectors.Element] = []
        self._link: list | None = None
        self._time: list | None = None
        self._seen_title = False

    def _inside(self) -> bool:
        return self._within is None or any(hit for _, hit in self._open)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        own = {k: v or "" for k, v in reversed(attrs)}
        if tag == "meta":
            for key in ("property", "name", "itemprop"):
                if key in own:
                    self.metas.setdefault((key, own[key]), own.get("content", ""))
            return
        if tag == "link" and "alternate" in own.get("rel", "").split() and re.search("rss|atom", own.get("type", ""), re.I) and own.get("href"):
            self.feeds.append(own["href"])
        if tag in _VOID:
            return
        self._path.append((tag, own))
        self._open.append((tag, self._within is not None and selectors.matches(self._path, self._within)))
        self._dropped += tag in DROPPED
        if tag == "a" and self._inside() and own.get("href"):
            self._link = [own["href"], []]
            self.links.append(self._link)
        elif tag == "time":
            self._time = [own.get("datetime", ""), []]
            self.times.append(self._time)
        elif tag == "script" and own.get("type") == "application/ld+json":
            self.blobs.append("")

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k][0] == tag:
                self._dropped -= sum(t in DROPPED for t, _ in self._open[k:])
                del self._open[k:], self._path[k:]
                break
        if tag == "a":
            self._link = None
        elif tag == "time":
            self._time = None
        elif tag == "title":
            self._seen_title = True

    def handle_data(self, data: str) -> None:
        names = [t for t, _ in self._open[-1:]]
        if "title" in names and not self._seen_title:
            self.title.append(data)  # a bare "<" comes as a piece of its own: pieces join as they stand
        text = data.strip()
        if not text:
            return
        if names == ["script"]:
            if self.blobs and self.blobs[-1] == "":
                self.blobs[-1] = data
            return
        if names == ["style"]:
            return
        if self._link is not None:
            self._link[1].append(text)
        if self._time is not None:
            self._time[1].append(text)
        self.all_texts.append(text)
        if not self._dropped:
            self.texts.append(text)


def _read(html: str | None, within: str | None = None) -> _Reader:
    reader = _Reader(within)
    reader.feed(html or "")
    reader.close()
    return reader


def _jsonld_dates(blobs: list[str]) -> list[str]:
    out = []
    for raw in blobs:
        try:
            found = json.loads(raw or "{}")
        except ValueError:
            continue
        for node in found if isinstance(found, list) else [found]:
            if isinstance(node, dict):
                out += [str(node[k]) for k in JSONLD_KEYS if node.get(k)]
    return out


def facts(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text, title, og_title`` and lists of what states a date: ``d_jsonld, d_meta, d_time array<string>, d_text string``."""
    own = [c for c in pages.columns if c != html]
    texts = [T.StructField(c, T.StringType()) for c in ("text", "title", "og_title")]
    lists = [T.StructField(c, T.ArrayType(T.StringType())) for c in ("d_jsonld", "d_meta", "d_time")]
    schema = T.StructType([*pages.select(*own).schema.fields, *texts, *lists, T.StructField("d_text", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[own].copy()
            read = [_read(h) for h in frame[html]]
            out["text"] = [" ".join(r.texts) for r in read]
            out["title"] = ["".join(r.title).strip() or None for r in read]
            out["og_title"] = [r.metas.get(("property", "og:title")) or None for r in read]
            out["d_jsonld"] = [_jsonld_dates(r.blobs) for r in read]
            out["d_meta"] = [[r.metas[k] for k in META_DATES if r.metas.get(k)] for r in read]
            out["d_time"] = [[t or " ".join(words) for t, words in r.times] for r in read]
            out["d_text"] = [" ".join(r.all_texts)[:1500] for r in read]
            yield out

    return pages.select(*own, html).mapInPandas(run, schema)


def find_date(rows: DataFrame, as_of) -> DataFrame:  # noqa: ANN001
    """``rows`` of :func:`facts` with ``page_date, page_date_source``: JSON-LD, then meta tags, then time elements, then a printed date; the first sane one."""
    first = lambda c: F.get(F.filter(F.transform(c, lambda t: sane(free_date(t), as_of)), lambda d: d.isNotNull()), F.lit(0))
    found = [(first("d_jsonld"), "jsonld"), (first("d_meta"), "meta"), (first("d_time"), "time_tag"), (sane(free_date(F.regexp_extract("d_text", BODY_DATE, 1)), as_of), "body_text")]
    both = F.coalesce(*[F.when(day.isNotNull(), F.struct(day.alias("day"), F.lit(where).alias("source"))) for day, where in found])
    return rows.withColumn("_d", both).withColumn("page_date", F.col("_d.day")).withColumn("page_date_source", F.col("_d.source")).drop("_d", "d_jsonld", "d_meta", "d_time", "d_text")


def listed(html: str | None, selector: str | None = None) -> Iterator[tuple[int, str, str | None]]:
    """Place, address as written and title of a list page's links."""
    for k, (href, words) in enumerate(_read(html, selector).links):
        if not href.startswith(SKIPPED_LINKS):
            title = " ".join(words)
            yield k, href, title if len(title) > 8 else None


def links(pages: DataFrame, selector: str | None = None, include: list[str] | None = None, exclude: list[str] | None = None, html: str = "html", url: str = "url") -> DataFrame:
    """Links of list pages: ``page_url, cand_ord, url, title``, on the page's own host, each address once (the first).

    ``selector`` is a CSS selector of what :mod:`.selectors` knows: links that match it, or stand inside what matches; one that is not understood is
    an error. Titles of eight characters or fewer are null.
    """
    if selector:
        selectors.parse(selector)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for page, raw in zip(frame["page_url"], frame["html"]):
                rows += [(page, *found) for found in listed(raw, selector)]
            yield pd.DataFrame(rows, columns=["page_url", "cand_ord", "href", "title"])

    rows = pages.select(F.col(url).alias("page_url"), F.col(html).alias("html")).mapInPandas(run, "page_url string, cand_ord int, href string, title string")
    rows = rows.withColumn("url", absolute("page_url", "href")).filter(F.col("url").isNotNull() & (host(F.col("url")) == host(F.col("page_url"))))
    rows = rows.filter(matches(F.col("url"), include or [], exclude or [])).drop("href")
    return first_of_each(rows.withColumn("_k", F.struct("page_url", "url")), "_k", ["cand_ord"]).drop("_k")


def declared_feeds(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``page_url, feed``: feeds that pages advertise."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(u, f) for u, h in zip(frame["page_url"], frame["html"]) for f in _read(h).feeds], columns=["page_url", "href"])

    rows = pages.select(F.col(url).alias("page_url"), F.col(html).alias("html")).mapInPandas(run, "page_url string, href string")
    return rows.select("page_url", absolute("page_url", "href").alias("feed"))
