"""The catalogue of sources and the taxonomy: small YAML files, read on the driver, and checked."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

REQUIRED = ("id", "org", "targets")
SCHEMA = (
    "source_ord int, target_ord int, id string, org string, country string, region string, language string, homepage string, name string, method string, url string, item_selector string, "
    "include_patterns array<string>, exclude_patterns array<string>, items_path string, url_field string, url_prefix string, title_field string, date_field string, page_param string, "
    "first_page int, pages int, days_back int"
)
METHODS = ("rss", "sitemap", "html", "json")


def load_sources(folder: str) -> list[dict[str, Any]]:
    """The sources of a folder's ``*.yml`` in order of name. None at all, or one without id, org or targets, is an error."""
    import yaml

    out = []
    for path in sorted(Path(folder).glob("*.yml")):
        own = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
        missing = [k for k in REQUIRED if k not in own]
        if missing:
            raise ValueError(f"{path.name}: no {', '.join(missing)}")
        out.append(own)
    if not out:
        raise ValueError(f"no sources in {folder}")
    return out


def targets(spark: SparkSession, sources: list[dict[str, Any]]) -> DataFrame:
    """A row for each target, with its place; methods that nothing serves stay visible in ``method``."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    rows = []
    for s, source in enumerate(sources):
        for t, target in enumerate(source["targets"]):
            rows.append(tuple({"source_ord": s, "target_ord": t, **{k: source.get(k) for k in ("id", "org", "country", "region", "language", "homepage")}}.get(n, target.get(n)) for n in names))
    return spark.createDataFrame(rows, SCHEMA)


def load_taxonomy(path: str) -> dict[str, Any]:
    """The taxonomy, read each time so that edits apply."""
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))
