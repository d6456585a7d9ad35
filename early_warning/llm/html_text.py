"""HTML extraction: layout-aware rendering of all visible text.

A tokenizer and a tree builder with implied start and end tags read the page; a renderer walks the tree without
recursion and lays out what a browser would show: collapsed white space, blocks on their own lines, blank lines
around paragraphs, indented and numbered lists, preformatted text as it is, and tables with aligned columns.
Not shown are metadata and script elements, elements hidden by attribute, inline style or a simple rule of the
page's own style sheets (tag, .class, #id and their pairs; the cascade decides between them), closed details but for their summary, and closed dialogs.

Edge cases: null and empty pages give an empty text; unclosed tags, comments and quotes end with the page; nesting
may be of any depth; a column is padded to ``PAD_CHARS`` at most; a table whose role is presentation (or none) is page
layout and is rendered cell after cell, any other table in aligned rows, however long its cells are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each, scan_texts

PAD_CHARS = 60
#: Lists and quotes nested deeper than this are not indented further.
INDENT_LEVELS = 24
#: Bounds that the HTML standard sets to the spans of cells.
MOST_COLUMNS, MOST_ROWS = 1000, 65534

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
#: Elements that a browser with scripts shows nothing of.
UNSEEN = frozenset("""head title script style template noscript noembed noframes iframe datalist area base link
    meta param source track audio video canvas object rp""".split())
#: Kinds of input elements whose value is shown as text.
SHOWN_INPUTS = frozenset("text search url tel email number submit button reset date time month week".split())
#: Blank lines before and after a block.
BLOCKS = dict.fromkeys("""address article aside center details dialog dd dir div dt fieldset figcaption footer form
    header hgroup legend li main menuitem nav option optgroup section summary body html caption""".split(), 0)
BLOCKS |= dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol dl menu blockquote pre figure table hr xmp listing".split(), 1)
CLOSES_P = frozenset(BLOCKS) - {"caption", "option", "optgroup", "body", "html", "legend"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu dir".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())
#: A start tag ends these open elements, but none beyond the bounds.
IMPLIED_ENDS = {
    "li": ({"li"}, LISTS | {"table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist", "table", "td"}),
    "optgroup": ({"option", "optgroup"}, {"select", "table", "td"}),
    "td": ({"td", "th", "caption"}, {"table"}),
    "th": ({"td", "th", "caption"}, {"table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, {"body", "table"}),
}
P_BOUNDS = frozenset("table td th caption button object body html".split())
END_BOUNDS = frozenset("table td th caption".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:[^>\"'=]++|=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|[=\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
_SELECTOR = re.compile(r"([a-z][\w-]*)?([.#][\w-]+)?\Z", re.I)
_GONE = re.compile(r"display\s*:\s*none", re.I)
_SEEN = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
#: Blocks whose rules hold on a screen: no media named, or one of these.
_SCREEN = re.compile(r"@media\s*(?:\Z|(?:.*,)?\s*(?:only\s+)?(?:all|screen)\s*(?:,|\Z))", re.I | re.S)
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "before")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children, self.before = tag, attrs, [], None


def _attributes(text: str) -> dict:
    if not text or text.isspace():
        return {}
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


class Builder:
    """Tree of a page."""

    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]
        #: where in ``open`` the elements of each tag stand
        self.places: dict[str, list[int]] = {}
        self.styles: list[str] = []

    def feed(self, page: str) -> Node:
        at, n = 0, len(page)
        while at < n:
            m = _TOKEN.search(page, at)
            if not m:
                self.text(page[at:])
                break
            if m.start() > at:
                self.text(page[at:m.start()])
            at = m.end()
            tag = m[2] and m[2].lower()
            if tag and m[1]:
                self.end(tag)
            elif tag:
                self.start(tag, _attributes(m[3]))
                if tag in RAW:
                    end = _RAW_END[tag].search(page, at)
                    stop = end.start() if end else n
                    if tag == "style":
                        self.styles.append(page[at:stop])
                    elif tag in ("textarea", "xmp"):
                        self.text(page[at:stop], entities=tag == "textarea")
                    at = stop
        return self.root

    def text(self, text: str, entities: bool = True) -> None:
        if entities and "&" in text:
            text = html.unescape(text)
        node = self.open[-1]
        if node.tag in TABLE_PARTS:
            if text.isspace():
                return
            # text between the cells stands before the table
            table = next(x for x in reversed(self.open) if x.tag == "table" or x is self.root)
            if table is not self.root:
                table.before = (table.before or []) + [text]
                return
        node.children.append(text)

    def _innermost(self, tags) -> int:
        """Place of the innermost open element of the tags, 0 if there is none."""
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=0)

    def _cut(self, at: int) -> None:
        """End all open elements from a place on."""
        while len(self.open) > at:
            self.places[self.open.pop().tag].pop()

    def _close(self, tags, bounds) -> bool:
        """End the innermost open element of the tags with all inside it, unless a bound comes first."""
        at = self._innermost(tags)
        if not at or at < self._innermost(bounds):
            return False
        self._cut(at)
        return True

    def start(self, tag: str, attrs: dict) -> None:
        if tag == "html":
            return
        if tag in CLOSES_P:
            self._close({"p"}, P_BOUNDS)
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self._cut(len(self.open) - 1)
        if tag in IMPLIED_ENDS:
            tags, bounds = IMPLIED_ENDS[tag]
            while self._close(tags, bounds):
                pass
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push(Node("tr", {}))
        node = Node(tag, attrs)
        self._push(node)
        if tag in VOID:
            self._cut(len(self.open) - 1)

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.places.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
            return
        if tag in ("html", "body"):
            return
        bounds = frozenset() if tag in END_BOUNDS or tag in TABLE_PARTS else END_BOUNDS
        if tag in ("tr", "td", "th", "thead", "tbody", "tfoot", "caption"):
            bounds = {"table"}
        elif tag not in BLOCKS and tag not in TABLE_PARTS:
            bounds = bounds | CLOSES_P  # the end of an inline element ends no block inside it
        self._close({tag}, bounds - {tag})


def screen_rules(sheet: str) -> list[tuple[str, str]]:
    """(selectors, declarations) of a style sheet that hold on a screen, in order; comments are left out, and blocks of
    other media or conditions with them."""
    sheet = _COMMENT.sub(" ", sheet)
    rules, blocks, at = [], [], 0  # blocks: of every open at-block, whether its rules hold
    for m in re.finditer(r"[{};]", sheet):
        head = sheet[at:m.start()]
        if m[0] == "{":
            if head.strip().startswith("@"):
                blocks.append(bool(_SCREEN.match(head.strip())))
            else:
                blocks.append(head.strip())
            at = m.end()
        elif m[0] == "}" and blocks:
            last = blocks.pop()
            if isinstance(last, str) and all(b is True for b in blocks):
                rules.append((last, head))
            at = m.end()
        elif m[0] == ";" and not (blocks and isinstance(blocks[-1], str)):
            at = m.end()  # an at-rule without a block
    return rules


class Hidden:
    """Visibility of elements under a page's own style sheets."""

    def __init__(self, styles: list[str]):
        #: (property, tag, mark) -> (rank, value): importance, specificity and order decide between values.
        self.rules: dict[tuple[str, str, str], tuple[tuple, str]] = {}
        for order, (selectors, body) in enumerate(rule for sheet in styles for rule in screen_rules(sheet)):
            for prop, value, important in _DECLARED.findall(body):
                for s in selectors.split(","):
                    m = _SELECTOR.match(s.strip())
                    if m and (m[1] or m[2]):
                        tag, mark = (m[1] or "").lower(), m[2] or ""
                        rank = (bool(important), mark[:1] == "#", mark[:1] == ".", bool(tag), order)
                        key = (prop.lower(), tag, mark)
                        self.rules[key] = max(self.rules.get(key, (rank, "")), (rank, value.lower()))

    def _ruled(self, prop: str, node: Node) -> str | None:
        """The value that the style sheets give to an element."""
        if not self.rules:
            return None
        marks = ["", *("." + c for c in node.attrs.get("class", "").split()), "#" + node.attrs.get("id", "")]
        found = [r for t in ("", node.tag) for m in marks if (r := self.rules.get((prop, t, m)))]
        return max(found)[1] if found else None

    def state(self, node: Node, parent: Node, seen: bool) -> bool | None:
        """None: no box at all; else whether the element's own text is seen."""
        tag, attrs = node.tag, node.attrs
        if tag in UNSEEN:
            return None
        if parent.tag == "details" and "open" not in parent.attrs and tag != "summary":
            return None
        style = attrs.get("style", "") if attrs else ""
        if attrs:
            if "hidden" in attrs or _GONE.search(style) or (tag == "input" and attrs.get("type", "").lower() == "hidden"):
                return None
        if tag == "dialog" and "open" not in attrs:
            return None
        if "display" not in style.lower() and self._ruled("display", node) == "none":
            return None
        shown = m[1].lower() if (m := _SEEN.search(style)) else self._ruled("visibility", node)
        return seen if shown in (None, "inherit") else shown not in ("hidden", "collapse")


class Flow:
    """Lines of one column of text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.indents: list[str] = []
        self.marker: str | None = None

    def _emit(self, line: str) -> None:
        if self.lines and self.gap:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        indent = "".join(self.indents[:INDENT_LEVELS])
        if self.marker is not None:
            if len(self.indents) <= INDENT_LEVELS:
                indent = indent[:-len(self.marker)]
            indent, self.marker = indent + self.marker, None
        self.lines.append(indent + line)

    def block(self, gap: int) -> None:
        line = "".join(self.line).strip(" ")
        self.line = []
        if line:
            self._emit(line)
        if self.lines:
            self.gap = max(self.gap, gap)

    def text(self, text: str) -> None:
        text = _SPACES.sub(" ", text)
        if text[:1] == " " and (not self.line or self.line[-1].endswith(" ")):
            text = text[1:]
        if text:
            self.line.append(text)

    def newline(self) -> None:
        """A line break: unlike the end of a block, it also ends an empty line."""
        line = "".join(self.line).strip(" ")
        self.line = []
        if line or self.lines:
            self._emit(line)

    def verbatim(self, lines: Sequence[str]) -> None:
        self.block(0)
        for x in lines:
            self._emit(x.rstrip())

    def done(self) -> list[str]:
        self.block(0)
        while self.lines and not self.lines[-1].strip():
            self.lines.pop()
        return self.lines


def _span(attrs: dict, name: str, most: int) -> int:
    m = re.match(r"\s*(\d{1,9})", attrs.get(name, ""))
    return min(most, max(1, int(m[1]))) if m else 1


def layout(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table of (lines, column span, row span) cells, columns aligned."""
    placed, taken, widths = [], {}, {}
    for row in rows:
        at, line = 0, []
        for lines, cols, deep in row:
            while taken.get(at):
                at += 1
            line.append((at, lines))
            width = min(PAD_CHARS, max(map(len, lines), default=0))
            if cols == 1:
                widths[at] = max(width, widths.get(at, 0))
            for c in range(at, at + cols):
                taken[c] = max(taken.get(c, 0), deep)
                widths.setdefault(c, 0)
            at += cols
        placed.append(line)
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
    # columns that no text stands in take no room
    starts, x = {}, 0
    for c in range(max(widths, default=-1) + 1):
        starts[c] = x
        x += widths[c] + 2 if widths.get(c) else 0
    out = []
    for line in placed:
        for i in range(max((len(lines) for _, lines in line), default=0)):
            text = ""
            for at, lines in line:
                if i < len(lines) and lines[i]:
                    text += " " * max(starts[at] - len(text), 2 if text else 0) + lines[i]
            out.append(text)
    return out


def render(page: str | None) -> str:
    """The visible text of a page."""
    if not page:
        return ""
    builder = Builder()
    root = builder.feed(page)
    hidden = Hidden(builder.styles)
    flow = Flow()
    flows: list[Flow] = []
    tables: list[dict] = []
    counters: list[int | None] = []
    pre = 0
    # what is still to do, the next last: (node, parent, seen) to enter, (node, None, seen) to leave
    todo: list[tuple] = [(root, root, True)]
    while todo:
        node, parent, seen = todo.pop()
        if parent is not None and isinstance(node, str):
            if not seen or parent.tag == "details" and "open" not in parent.attrs:
                continue
            if pre:
                first, *rest = node.replace("\r\n", "\n").split("\n")
                flow.line.append(first)
                for x in rest:
                    flow._emit("".join(flow.line).rstrip())
                    flow.line = [x]
            else:
                flow.text(node)
            continue
        tag = node.tag
        if parent is not None:
            state = hidden.state(node, parent, seen)
            if state is None:
                continue
            if tag == "br":
                flow.newline()
                continue
            if tag == "input":
                if state and node.attrs.get("type", "text").lower() in SHOWN_INPUTS:
                    flow.text(node.attrs.get("value", ""))
                continue
            if tag in ("td", "th") and tables:
                flows.append(flow)
                flow = Flow()
            elif tag == "tr" and tables:
                tables[-1]["rows"].append([])
            elif tag in BLOCKS:
                flow.block(BLOCKS[tag] if not (tag in LISTS and counters) else 0)
            if tag == "table":
                for x in node.before or ():
                    if state:
                        flow.text(x)
                flow.block(1)
                tables.append({"rows": []})
            elif tag in LISTS:
                start = _span(node.attrs, "start", 10**9) if "start" in node.attrs else 1
                counters.append(start if tag == "ol" else None)
            elif tag == "li":
                n = counters[-1] if counters else None
                if n is not None:
                    counters[-1] = n + 1
                flow.marker = "- " if n is None else f"{n}. "
                flow.indents.append(" " * len(flow.marker))
            elif tag in ("blockquote", "dd"):
                flow.indents.append("  ")
            elif tag in ("pre", "listing", "xmp", "textarea"):
                pre += 1
            todo.append((node, None, state))
            todo.extend((c, node, state) for c in reversed(node.children))
            continue
        # leaving
        if tag in ("pre", "listing", "xmp", "textarea"):
            pre -= 1
            line, flow.line = "".join(flow.line).rstrip(), []
            if line:
                flow._emit(line)
        if tag in ("td", "th") and tables:
            lines = flow.done()
            flow = flows.pop()
            rows = tables[-1]["rows"]
            (rows[-1] if rows else rows.append([]) or rows[-1]).append(
                (lines, _span(node.attrs, "colspan", MOST_COLUMNS), _span(node.attrs, "rowspan", MOST_ROWS)))
        elif tag == "table":
            rows = tables.pop()["rows"]
            if node.attrs.get("role", "").strip().lower() in ("presentation", "none"):
                rows = [[cell] for row in rows for cell in row]
            flow.verbatim(layout(rows))
            flow.block(1)
        elif tag in BLOCKS:
            flow.block(BLOCKS[tag] if not (tag in LISTS and len(counters) > 1) else 0)
        if tag in LISTS:
            counters.pop()
        elif tag == "li":
            flow.indents.pop()
            flow.marker = None
        elif tag in ("blockquote", "dd"):
            flow.indents.pop()
    return "\n".join(flow.done())


def extract_text(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """``keep``, the visible ``text``, its lines and characters."""
    kept = [f"k{i}" for i in range(len(keep))]
    plain = pages.select(*(F.col(c).alias(k) for k, c in zip(kept, keep)), F.col(html_col).alias("t__"))
    found = scan_texts(plain, kept, ["t__"], lambda: each(lambda page: (render(page),)), [("text", "string")], binary=False)
    return found.select(*(F.col(k).alias(c) for k, c in zip(kept, keep)), "text",
                        F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
                        F.length("text").cast("long").alias("n_chars"))
