"""JSON, array and map functions."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of key names that suggest a link or a date.
LINK_HINTS = ["url", "link", "slug", "href", "path", "permalink"]
DATE_HINTS = ["date", "publish", "created", "updated", "time"]


def json_path(dotted: str) -> str:
    """``a.0.b`` as ``$.a[0].b``; '' is the whole."""
    return "$" + "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in dotted.split(".") if p)


def dig(text: Column, dotted: str, kind: str = "string") -> Column:
    """The value at a dotted path of a JSON text; null where it is not there or the text is no JSON."""
    return F.try_variant_get(F.try_parse_json(text), json_path(dotted), kind)


def bury(body: dict[str, Any], dotted: str, value: Any) -> dict[str, Any]:
    """Sets the value at a dotted path of a request, making objects on the way."""
    at = body
    *way, last = dotted.split(".")
    for p in way:
        at = at.setdefault(p, {})
    at[last] = value
    return body


def json_texts(text: Column) -> Column:
    """A JSON array of texts as an array; null and other JSON as empty."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def mapped_labels(raw: Column, mapping: dict[str, str]) -> Column:
    """A publisher's labels in ours: trimmed and lower-cased for the look-up, unknown ones dropped, each target once, in order."""
    pairs = [F.lit(x) for k, v in mapping.items() for x in (k.strip().lower(), v)]
    if not pairs:
        return F.array().cast("array<string>")
    table = F.create_map(*pairs)
    found = F.transform(raw, lambda x: F.try_element_at(table, F.lower(F.trim(x))))
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (x != "")))


def labels(text: Column, field: str, item_key: str = "name") -> Column:
    """The labels in a field of a JSON text: one value, a list of values or a list of objects."""
    value = F.try_variant_get(F.try_parse_json(text), json_path(field), "variant")
    listed = F.try_variant_get(value, "$", "array<variant>")
    items = F.when(listed.isNotNull(), listed).when(value.isNotNull(), F.array(value))
    texts = F.transform(items, lambda v: F.coalesce(F.try_variant_get(v, json_path(item_key), "string"), F.try_variant_get(v, "$", "string")))
    return F.coalesce(F.filter(F.transform(texts, lambda t: F.trim(t)), lambda t: t.isNotNull() & (t != "")), F.array().cast("array<string>"))


def valid_only(values: Column, allowed: list[str]) -> Column:
    """The values that are allowed, in order, repeats included."""
    known = F.array(*map(F.lit, allowed))
    return F.filter(values, lambda v: F.array_contains(known, v))


def any_of(values: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(values, F.array(*map(F.lit, wanted)))


def outline(value: Any, depth: int = 0) -> str:
    """The shape of a JSON value: 14 keys an object, three levels, long scalars cut."""
    if isinstance(value, dict):
        if depth >= 3:
            return "{...}"
        inner = ", ".join(f"{k}: {outline(v, depth + 1)}" for k, v in list(value.items())[:14])
        return "{" + inner + (", ..." if len(value) > 14 else "") + "}"
    if isinstance(value, list):
        return f"[{len(value)}" + (f" x {outline(value[0], depth + 1)}" if value and depth < 3 else "") + "]"
    text = json.dumps(value, ensure_ascii=False)
    return text if len(text) <= 52 else text[:51] + "…"


def arrays_in(value: Any, path: str = "") -> list[tuple[str, int, Any]]:
    """Path, size and first element of each array that objects lead to; the largest first."""
    found, todo = [], [(path, value)]
    while todo:
        at, v = todo.pop()
        if isinstance(v, list):
            found.append((at, len(v), v[0] if v else None))
        elif isinstance(v, dict):
            todo.extend((f"{at}.{k}" if at else k, x) for k, x in v.items())
    return sorted(found, key=lambda x: (-x[1], x[0]))


def hinted(keys: list[str], hints: list[str]) -> list[str]:
    """Keys whose name suggests what the hints do."""
    return [k for k in keys if any(h in k.lower() for h in hints)]
