"""CSS selectors over a path of open elements: types, classes, ids, attributes, descendants, children, lists."""

from __future__ import annotations

import re
from functools import lru_cache

#: An element: its tag in lower case, and its attributes.
Element = tuple[str, dict[str, str]]

_PIECE = re.compile(
    r"\s*(?P<comma>,)\s*|\s*(?P<child>>)\s*|(?P<below>\s+)|(?P<tag>\*|[A-Za-z][\w-]*)|\.(?P<cls>-?[A-Za-z_][\w-]*)|#(?P<id>[\w-]+)"
    r"|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~|^$*]?=)\s*(?:\"(?P<double>[^\"]*)\"|'(?P<single>[^']*)'|(?P<bare>[^\]\s\"']+))\s*)?\]"
)


@lru_cache(maxsize=256)
def parse(text: str) -> tuple:
    """Alternatives, each a sequence of (how it stands to the one before, tests). What is not understood is an error, never an empty result."""
    alternatives, steps, tests, how, at = [], [], [], " ", 0
    text = text.strip()
    while at <= len(text):
        m = _PIECE.match(text, at) if at < len(text) else None
        if at < len(text) and not m:
            raise ValueError(f"selector not understood at {text[at:]!r}: {text!r}")
        kind = m.lastgroup if m else "comma"
        if kind in ("comma", "child", "below"):
            if not tests:
                raise ValueError(f"selector with an empty part: {text!r}")
            steps.append((how, tuple(tests)))
            tests, how = [], ">" if kind == "child" else " "
            if kind == "comma":
                alternatives.append(tuple(steps))
                steps = []
        elif m["tag"]:
            tests.append(("tag", m["tag"].lower(), "", ""))
        elif m["cls"]:
            tests.append(("attr", "class", "~=", m["cls"]))
        elif m["id"]:
            tests.append(("attr", "id", "=", m["id"]))
        else:
            tests.append(("attr", m["attr"].lower(), m["op"] or "", next((m[g] for g in ("double", "single", "bare") if m[g] is not None), "")))
        at = m.end() if m else len(text) + 1
    return tuple(alternatives)


def _passes(element: Element, tests: tuple) -> bool:
    tag, attrs = element
    for kind, name, op, value in tests:
        if kind == "tag":
            if name not in ("*", tag):
                return False
            continue
        own = attrs.get(name)
        if own is None:
            return False
        fine = {
            "": True,
            "=": own == value,
            "~=": value in own.split(),
            "|=": own == value or own.startswith(f"{value}-"),
            "^=": bool(value) and own.startswith(value),
            "$=": bool(value) and own.endswith(value),
            "*=": bool(value) and value in own,
        }[op]
        if not fine:
            return False
    return True


def _fits(path: list[Element], steps: tuple) -> bool:
    (how, tests), before = steps[-1], steps[:-1]
    if not _passes(path[-1], tests):
        return False
    if not before:
        return True
    ends = [len(path) - 1] if how == ">" else range(len(path) - 1, 0, -1)
    return any(end > 0 and _fits(path[:end], before) for end in ends)


def matches(path: list[Element], selector: tuple) -> bool:
    """Whether the last element of a path from the root matches one of the alternatives."""
    return any(_fits(path, steps) for steps in selector)
