"""JSON APIs: a Python data source that walks pages, and candidates from its rows."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import date
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.dates import api_date
from ..functions.jsons import bury, dig, labels, mapped_labels
from ..functions.urls import with_prefix
from ..operators.discover import first_of_each


def request_of(target: dict[str, Any], page: int) -> dict[str, Any]:
    """Method, address, parameters and body of a page's request; the page's number goes to the body of a POST or to the parameters of a GET."""
    method = (target.get("http_method") or "GET").upper()
    params, body = dict(target.get("params") or {}), json.loads(json.dumps(target.get("body") or {}))
    if target.get("page_param"):
        if method == "POST":
            bury(body, target["page_param"], page)
        else:
            params[target["page_param"]] = page
    return {"method": method, "url": target["url"], "params": params, "body": body, "headers": dict(target.get("headers") or {})}


def read_response(status: int, text: str) -> Any:
    """The JSON of a response; other statuses and other texts are errors that quote 300 characters."""
    if status != 200:
        raise RuntimeError(f"http {status}: {text[:300]}")
    try:
        return json.loads(text)
    except ValueError as e:
        raise RuntimeError(f"no JSON: {text[:300]}") from e


class _Page(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)


class PagedJson(DataSource):
    """Format ``paged_json``: a row ``page, ord, row`` (JSON text) for each item. A partition for each page.

    Options: ``folder`` (files ``0.json`` and so on: responses kept earlier), ``first_page``, ``pages``, ``items_path``.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, ord int, row string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.path = options["folder"], options.get("items_path", "")
        self.first, self.n = int(options.get("first_page", 0)), int(options.get("pages", 1))

    def partitions(self) -> list[_Page]:
        return [_Page(k) for k in range(self.first, self.first + self.n)]

    def read(self, partition: _Page) -> Iterator[tuple[int, int, str]]:
        file = Path(self.folder) / f"{partition.value}.json"
        if file.exists():
            yield from items_of(json.loads(file.read_text(encoding="utf-8")), self.path, partition.value)


def items_of(value: Any, path: str, page: int) -> Iterator[tuple[int, int, str]]:
    """The items at a dotted path of a page."""
    for p in path.split(".") if path else []:
        try:
            value = value[int(p)] if isinstance(value, list) else value[p]
        except (KeyError, IndexError, ValueError, TypeError):
            return
    for k, row in enumerate(value if isinstance(value, list) else []):
        yield page, k, json.dumps(row, ensure_ascii=False)


def candidates(rows: DataFrame, target: dict[str, Any], as_of: date) -> DataFrame:
    """Candidates of ``page, ord, row``: address, title, date, and the publisher's labels in ours; each address once, the first."""
    out = rows.withColumn("url", with_prefix(dig(F.col("row"), target["url_field"]), target.get("url_prefix", ""))).filter(F.col("url").isNotNull() & (F.col("url") != ""))
    out = out.withColumn("title", dig(F.col("row"), target["title_field"]) if target.get("title_field") else F.lit(None).cast("string"))
    day = api_date(dig(F.col("row"), target["date_field"]), as_of) if target.get("date_field") else F.lit(None).cast("date")
    out = out.withColumn("published_at", day).withColumn("date_source", F.when(F.col("published_at").isNotNull(), F.lit("api")))
    for axis, single in (("content_type", True), ("topics", False)):
        spec = (target.get("field_map") or {}).get(axis)
        raw = labels(F.col("row"), spec["field"], spec.get("item_key", "name")) if spec else F.array().cast("array<string>")
        mapped = mapped_labels(raw, spec.get("map") or {}) if spec else raw
        out = out.withColumn(f"pub_{axis}", F.get(raw, F.lit(0)) if single else raw).withColumn(axis, F.get(mapped, F.lit(0)) if single else mapped)
    return first_of_each(out.drop("row"), "url", ["page", "ord"])


def dated(rows: DataFrame, target: dict[str, Any], as_of: date) -> DataFrame:
    """``page, ord, published_at`` of ``page, ord, row``."""
    return rows.select("page", "ord", api_date(dig(F.col("row"), target["date_field"]), as_of).alias("published_at"))


def live(target: dict[str, Any], ask: Callable[[dict[str, Any]], tuple[int, str]], page: int) -> list[tuple[int, int, str]]:
    """A page's items over ``ask`` (request to status and text)."""
    return list(items_of(read_response(*ask(request_of(target, page))), target.get("items_path") or "", page))
