"""HTML to text by layout: a tree builder with implied tags and visibility rules, and a renderer that emits all visible text.

The tree builder closes and opens tags that HTML lets authors omit (paragraphs, list items, table rows and cells, options, definition terms), ignores stray
end tags, and keeps script-like content apart. Not visible are the head, scripts, styles, templates and other content that browsers do not paint, elements
with ``hidden``, ``display:none`` or ``visibility:hidden`` in their style, and what a style sheet of the page hides by a plain selector (tag, class,
id), in media blocks if they apply to a screen of the size ``SCREEN``. Everything else stays, navigation and footers included, formulas, the texts of drawings (a line each), all
options of a selection and the content of text areas.

Layout: white space collapses except in ``pre``; paragraphs, headings, lists, tables and quotes stand apart by a blank line, other blocks by a line break; list items carry
``-`` or their number and are indented by nesting; cells of a table are padded to columns (a cell of over ``MAX_PAD`` characters does not widen its column).

Each page is a task-local computation on its whole text; the walk uses its own stack, so deep nesting is no limit. Defined results: null
html gives null text and zero counts; empty html gives ''; repeated rows all stay; other columns pass through, but ``text`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import others, spread

MAX_PAD = 40

# Element names of the HTML standard by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head title script style template noscript iframe noembed noframes object audio video canvas datalist annotation annotation-xml mphantom".split())
#: In an svg, what is drawn elsewhere or not at all; of the rest only these elements hold text.
NOT_DRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker".split())
DRAWN = frozenset("text foreignobject".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr menu dir".split())
BLOCKS = APART | CLOSES_P | frozenset("html body tr caption tbody thead tfoot optgroup option legend select textarea".split())
BARRIERS = frozenset("table td th caption button template html body".split())
#: A start tag ends open elements of these names, as far as the nearest of the others.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split()) | BARRIERS),
    "dd": (frozenset("dd dt".split()), frozenset(["dl"]) | BARRIERS),
    "dt": (frozenset("dd dt".split()), frozenset(["dl"]) | BARRIERS),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "tr": (frozenset("tr caption".split()), frozenset("table tbody thead tfoot".split())),
    "tbody": (frozenset("tbody thead tfoot caption".split()), frozenset(["table"])),
    "thead": (frozenset("tbody thead tfoot caption".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot caption".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset("select optgroup datalist".split())),
    "rt": (frozenset("rt rp".split()), frozenset(["ruby"])),
    "rp": (frozenset("rt rp".split()), frozenset(["ruby"])),
}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_BRACE = re.compile(r"[{}]")
_FEATURE = re.compile(r"\(\s*(min|max)-(width|height)\s*:\s*([\d.]+)\s*(px|em|rem)\s*\)\Z")
#: The screen for which media rules are judged, in CSS pixels.
SCREEN = {"width": 1280, "height": 720}
_PLAIN = re.compile(r"([a-zA-Z][\w-]*)?(?:([.#])([\w-]+))?\Z")


class Node:
    """An element: its name, attributes and children (elements and texts)."""

    __slots__ = ("attrs", "kids", "name")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.kids = name, attrs, []


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def parse(html: str) -> tuple[Node, list[str]]:
    """The tree, and the texts of its style sheets."""
    root = Node("html", {})
    stack, sheets, at, size = [root], [], 0, len(html)
    count: dict[str, int] = {}  # open elements by name, so that a search for none of them ends at once

    def open_(name: str, attrs: dict[str, str]) -> Node:
        node = Node(name, attrs)
        stack[-1].kids.append(node)
        stack.append(node)
        count[name] = count.get(name, 0) + 1
        return node

    def pop() -> None:
        count[stack.pop().name] -= 1

    def close(names: frozenset, barriers: frozenset) -> bool:
        if not any(count.get(n) for n in names):
            return False
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in names:
                while len(stack) > k:
                    pop()
                return True
            if stack[k].name in barriers:
                return False
        return False

    while at < size:
        found = _MARKUP.search(html, at)
        if not found:
            stack[-1].kids.append(unescape(html[at:]))
            break
        if found.start() > at:
            stack[-1].kids.append(unescape(html[at : found.start()]))
        at = max(found.end(), at + 1)
        if not found[2]:
            continue
        name = found[2].lower()
        if found[1]:
            if name == "br":
                stack[-1].kids.append(Node("br", {}))
            elif name in ("html", "body"):
                pass  # what follows still belongs to the body
            elif name in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption"):
                close(frozenset([name]), frozenset(["table"]))
            elif not close(frozenset([name]), BARRIERS - {name}) and name == "p":
                stack[-1].kids.append(Node("p", {}))
            continue
        if name in ("html", "body"):
            root.attrs.update(_attributes(found[3]) if "=" in found[3] or "hidden" in found[3] else {})
            if name == "body":
                close(frozenset(["head"]), frozenset())
            continue
        if name in CLOSES_P:
            close(frozenset(["p"]), BARRIERS)
        if name in HEADINGS and stack[-1].name in HEADINGS:
            pop()
        if name in ENDS:
            close(*ENDS[name])
        if name in ("td", "th") and stack[-1].name in ("table", "tbody", "thead", "tfoot"):
            open_("tr", {})
        attrs = _attributes(found[3]) if found[3] else {}
        if name in VOID or (found[3].endswith("/") and (count.get("svg") or count.get("math") or name in ("svg", "math"))):
            stack[-1].kids.append(Node(name, attrs))
        elif name in RAW:
            end = re.compile(rf"</{name}\s*/?>?", re.I).search(html, at)
            stop = end.start() if end else size
            node = Node(name, attrs)
            node.kids.append(unescape(re.sub(r"\A\r?\n", "", html[at:stop])) if name == "textarea" else html[at:stop])
            stack[-1].kids.append(node)
            if name == "style":
                sheets.append(f"@media {attrs['media']}{{{html[at:stop]}}}" if attrs.get("media", "").strip() else html[at:stop])
            at = end.end() if end else size
        elif stack[-1].name == "head" and name not in ("noscript", "template"):
            pop()
            open_(name, attrs)
        else:
            open_(name, attrs)
    return root, sheets


def on_screen(query: str) -> bool:
    """Whether a media query list applies to the screen; a condition that is not known does not hold."""

    def holds(part: str) -> bool | None:
        if part in ("", "all", "screen"):
            return True
        if part in ("print", "speech"):
            return False
        if m := _FEATURE.match(part):
            try:
                size = float(m[3]) * (1 if m[4] == "px" else 16)
            except ValueError:
                return None
            return SCREEN[m[2]] >= size if m[1] == "min" else SCREEN[m[2]] <= size
        return None

    for one in query.lower().split(","):
        one = re.sub(r"\A\s*only\s+", "", one).strip()
        negated = one.startswith("not ")
        parts = [holds(p.strip()) for p in re.split(r"\band\b", one[4:] if negated else one)]
        if (False in parts) if negated else all(parts):
            return True
    return False


def _rules(sheet: str) -> Iterator[tuple[str, str]]:
    """Selectors and bodies of the rules of a sheet, without those of media blocks that do not apply."""
    open_, at = [], 0  # for each open block: what stands before it, where it starts, whether it applies
    for m in _BRACE.finditer(sheet):
        if m[0] == "{":
            head = sheet[at : m.start()].rpartition(";")[2].strip()
            applies = (not open_ or open_[-1][2]) and (not head.lower().startswith("@media") or on_screen(head[6:]))
            open_.append((head, m.end(), applies))
        elif open_:
            head, start, applies = open_.pop()
            if applies and not head.startswith("@") and "{" not in sheet[start : m.start()]:
                yield head, sheet[start : m.start()]
        at = m.end()


def hiding_selectors(sheets: list[str]) -> set[tuple[str, str, str]]:
    """Plain selectors (tag, ``.`` or ``#``, name) under which a style sheet hides elements."""
    out = set()
    for sheet in sheets:
        if "none" in sheet or "hidden" in sheet or "collapse" in sheet:
            for selectors, body in _rules(re.sub(r"/\*.*?\*/", "", sheet, flags=re.S)):
                if _HIDES.search(body):
                    for s in selectors.split(","):
                        if (m := _PLAIN.match(s.strip())) and (m[1] or m[3]):
                            out.add(((m[1] or "").lower(), m[2] or "", m[3] or ""))
    return out


def hidden(node: Node, selectors: set[tuple[str, str, str]]) -> bool:
    attrs = node.attrs
    if node.name in UNSEEN or "hidden" in attrs or (node.name == "input" and attrs.get("type", "").lower() == "hidden") or (node.name == "dialog" and "open" not in attrs):
        return True
    if "style" in attrs and _HIDES.search(attrs["style"]):
        return True
    if selectors:
        names = [("", "")] + [(".", c) for c in attrs.get("class", "").split()] + ([("#", attrs["id"])] if "id" in attrs else [])
        return any((tag, *n) in selectors for tag in ("", node.name) for n in names if tag or n[0])
    return False


def drawn(svg: Node, selectors: set[tuple[str, str, str]]) -> list[Node]:
    """The texts of a drawing, each as a block."""
    out, walk = [], list(reversed(svg.kids))
    while walk:
        node = walk.pop()
        if isinstance(node, str) or node.name in NOT_DRAWN or hidden(node, selectors):
            continue
        if node.name in DRAWN:
            block = Node("div", {})
            block.kids = node.kids
            out.append(block)
        else:
            walk.extend(reversed(node.kids))
    return out


class Flow:
    """Lines of a block of text as they come about."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.held: list[str] = []
        self.gap, self.indent, self.marker, self.open_space = 0, 0, "", True

    def text(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if self.open_space and s.startswith(" "):
            s = s[1:]
        if s:
            self.held.append(s)
            self.open_space = s.endswith(" ")

    def verbatim(self, s: str) -> None:
        first, *rest = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.held.append(first)
        for line in rest:
            self.line(keep=True)
            self.held.append(line)
        self.open_space = False

    def line(self, keep: bool = False) -> None:
        """Ends the line; an empty one stays only with ``keep``."""
        s = "".join(self.held).rstrip()
        self.held, self.open_space = [], True
        if s or (keep and self.lines):
            if self.gap > 1 and self.lines:
                self.lines.append("")
            lead = " " * self.indent
            if self.marker and s:
                lead, self.marker = lead[: max(0, self.indent - len(self.marker))] + self.marker, ""
            self.lines.append((lead + s).rstrip())
            self.gap = 0

    def block(self, gap: int) -> None:
        self.line()
        self.gap = max(self.gap, gap)

    def done(self) -> list[str]:
        self.line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def aligned(rows: list[list[tuple[int, list[str]]]]) -> list[str]:
    """Lines of a table whose cells are (columns spanned, lines)."""
    widths: dict[int, int] = {}
    for row in rows:
        at = 0
        for span, lines in row:
            if span == 1:
                widths[at] = max([widths.get(at, 0), *(len(x) for x in lines if len(x) <= MAX_PAD)])
            at += span
    out = []
    for row in rows:
        for parts in zip_longest(*(lines for _, lines in row), fillvalue=""):
            line, at = [], 0
            for (span, _), part in zip(row, parts):
                width = sum(widths.get(at + k, 0) for k in range(span)) + 2 * (span - 1)
                line.append(part.ljust(width))
                at += span
            out.append("  ".join(line).rstrip())
    return [x for x in out if x]


def render(html: str) -> str:
    """All visible text of a page."""
    root, sheets = parse(html)
    selectors = hiding_selectors(sheets)
    flows, tables, lists, pre = [Flow()], [], [], 0
    walk: list[tuple[Node | str, bool]] = [(root, False)]
    while walk:
        node, leaving = walk.pop()
        flow = flows[-1]
        if isinstance(node, str):
            flow.verbatim(node) if pre else flow.text(node)
            continue
        name = node.name
        if not leaving:
            if hidden(node, selectors):
                continue
            if name == "br":
                flow.line(keep=True)
                continue
            if name in ("img", "input"):
                shown = node.attrs.get("alt", "") if name == "img" else node.attrs.get("value", "") if node.attrs.get("type", "").lower() in ("submit", "button", "reset") else ""
                flow.text(shown)
                continue
            if name in VOID:
                if name == "hr":
                    flow.block(2)
                continue
            if name in ("td", "th") and tables:
                flows.append(Flow())
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in BLOCKS:
                flow.block(1 if name not in APART or (name in ("ul", "ol", "menu", "dir") and lists) else 2)
            if name == "table":
                tables.append([])
            elif name in ("ul", "ol", "menu", "dir"):
                start = node.attrs.get("start", "1")
                lists.append([name == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            elif name == "li":
                own = lists[-1] if lists else [False, 1]
                mark = f"{own[1]}. " if own[0] else "- "
                own[1] += 1
                flow.indent += len(mark)
                flow.marker = mark
                walk.append((_Indent(len(mark)), True))
            elif name in ("blockquote", "dd"):
                flow.indent += 2
                walk.append((_Indent(2), True))
            elif name in ("pre", "textarea"):
                pre += 1
            walk.append((node, True))
            walk.extend((kid, False) for kid in reversed(drawn(node, selectors) if name == "svg" else node.kids))
            continue
        if name == "#indent":
            flow.line()
            flow.indent, flow.marker = max(0, flow.indent - node.width), ""
        elif name in ("td", "th") and tables:
            cell = flows.pop().done()
            if not tables[-1]:
                tables[-1].append([])
            span = node.attrs.get("colspan", "1")
            tables[-1][-1].append((min(int(span), 100) if re.fullmatch(r"[1-9]\d{0,5}", span) else 1, cell))
        elif name == "table":
            flow.block(2)
            for line in aligned(tables.pop()):
                flow.held = [line]
                flow.line()
            flow.block(2)
        elif name in BLOCKS and not (name == "tr" and tables):
            if name in ("ul", "ol", "menu", "dir") and lists:
                lists.pop()
            if name in ("pre", "textarea"):
                pre -= 1
            flow.block(1 if name not in APART or (name in ("ul", "ol", "menu", "dir") and lists) else 2)
    return "\n".join(flows[0].done())


class _Indent(Node):
    """Stands on the walk where an indented block ends."""

    __slots__ = ("width",)

    def __init__(self, width: int):
        super().__init__("#indent", {})
        self.width = width


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the html column, with ``text string``."""
    own = others(pages, html, "text")
    schema = T.StructType([*pages.select(*own).schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if h is None else render(h) for h in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(texts, pa.string())], [f.name for f in schema.fields])

    return spread(pages.select(*own, html)).mapInArrow(run, schema)


def figures(extracted: DataFrame) -> DataFrame:
    """With the number of characters and of lines that hold text."""
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != "")
    return extracted.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"))
