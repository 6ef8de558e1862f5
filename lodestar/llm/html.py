"""Layout-aware HTML rendering to plain text.

A tree builder reads tags, comments and text, closes elements whose end tags
HTML lets authors leave out (paragraphs, list items, table parts, options,
definition terms), and matches end tags inside their scope.  The renderer
leaves out what a browser does not show (scripts, styles, head, templates,
``hidden``, ``display:none``, ``visibility:hidden``, the fallback content of
media elements) and keeps all visible text: blocks on their own lines,
paragraphs and headings with a blank line between, list items with marks and
nested indent, table cells in aligned columns (``colspan`` and ``rowspan``
hold their place), preformatted text as it is.

Formulas are shown by their text, the parts of fractions and scripts apart by
a space, without annotations.  Of drawings, what ``text`` and
``foreignObject`` hold is shown, each text on a line of its own; text of
``defs`` and ``symbol`` counts as shown, once, where it is written.

Each page is handled by itself, whole, and elements nest without a limit.
Layout alone has bounds: indents grow no wider than ``WIDEST`` columns, and
tables within ``DEPTH`` others, or whose padding would pass ``PADDING``
characters, have their cells apart by spaces, not aligned.

Results for edge cases: null html gives null text, empty html or one without
visible text gives an empty text; a null id is kept; repeated rows are each
rendered; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship_code

DEPTH, WIDEST, PADDING = 200, 400, 1 << 24

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes noembed iframe xmp plaintext".split())
UNSEEN = frozenset("head script style template title noscript noframes noembed iframe object audio video canvas datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset menu dir xmp".split())
BLOCK = SPACED | frozenset(
    "html body address article aside center dd details dialog div dt figcaption footer form header hgroup legend li main nav "
    "optgroup option search section summary tbody thead tfoot tr caption".split())
PARAGRAPH_ENDS = BLOCK - frozenset("html body li dd dt option optgroup caption tbody thead tfoot tr legend summary".split()) | {"li", "dd", "dt"}
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}), "th": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
}
SCOPE = frozenset("table td th caption html template foreignobject desc mi mo mn ms mtext annotation-xml".split())
TABLE_PARTS = frozenset("tr tbody thead tfoot td th caption template".split())
# Within svg and math: what is not shown, what holds HTML again, HTML that ends them, and formula parts set apart.
UNSEEN_WITHIN = frozenset("desc metadata annotation annotation-xml mphantom".split())
HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext".split())
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
MATH_APART = frozenset("mfrac mroot msub msup msubsup munder mover munderover mmultiscripts mtr mlabeledtr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|</([A-Za-z][^\s/>]*+)[^>]*+>?"
    r"|<([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)  # the last: quotes that do not pair, or no end
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")
_UNQUOTED_END = re.compile(r"=\s*[^\s\"'>]+\Z")
_FONT = re.compile(r"(?<![^\s/\"'])(?:color|face|size)\s*=", re.I)


class Element:
    """``inner``: what its contents belong to, "" for HTML, else "svg" (not shown as text), "svg text" or "math"."""

    __slots__ = ("apart", "children", "hidden", "inner", "rows", "span", "start", "tag")

    def __init__(self, tag: str, attributes: str = "", within: str = ""):
        self.tag, self.children = tag, []
        self.hidden, self.span, self.rows, self.start = tag in UNSEEN, 1, 1, 1
        self.inner, self.apart = within, False
        if tag in ("svg", "math"):
            self.inner = tag
        elif within:
            self.hidden = self.hidden or tag in UNSEEN_WITHIN
            if tag in HOLDS_HTML or tag == "annotation-xml" and "html" in attributes.lower():
                self.inner = ""
            elif within == "svg" and tag == "text":
                self.inner, self.apart = "svg text", True
            self.apart = self.apart or tag in ("mtr", "mlabeledtr", "foreignobject")
        if attributes and not attributes.isspace():
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), next((v for v in values if v), "")
                if name == "hidden" or name == "style" and _HIDING.search(unescape(value)) or \
                        tag == "input" and name == "type" and value.lower() == "hidden":
                    self.hidden = True
                elif name == "colspan" and value.isdecimal():
                    self.span = min(max(1, int(value)), 100)
                elif name == "rowspan" and value.isdecimal():
                    self.rows = min(int(value), 65534)  # 0: to the end of the row group
                elif name == "start" and value.lstrip("-").isdecimal():
                    self.start = int(value)
                elif (within or tag == "svg") and name in ("display", "visibility") and value.lower() in ("none", "hidden", "collapse"):
                    self.hidden = True
                elif within == "svg text" and tag == "tspan" and name in ("x", "y"):
                    self.apart = True
        if tag == "dialog" and not re.search(r"\bopen\b", attributes):
            self.hidden = True


class Open:
    """The open elements from the root on, and the places of each tag among them."""

    def __init__(self, root: Element):
        self.stack, self.places = [root], {}

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.stack))
        self.stack.append(e)

    def cut(self, first: int) -> None:
        for e in self.stack[first:]:
            self.places[e.tag].pop()
        del self.stack[first:]

    def nearest(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, tags, scope) -> None:
        """Close all of ``tags`` that no element of ``scope`` shields."""
        own = [at for t in tags if (at := self.places.get(t))]
        if own:
            shield = self.nearest(scope)
            last = min((at[i] for at in own if (i := bisect_right(at, shield)) < len(at)), default=None)
            if last is not None:
                self.cut(last)

    def end(self, tag: str) -> None:
        """An end tag closes its element, unless a table part stands between."""
        at = self.places.get(tag)
        if at and at[-1] >= (0 if tag == "table" else self.nearest(("table",) if tag in TABLE_PARTS else SCOPE)):
            self.cut(at[-1])

    def leave(self) -> None:
        """Close svg and math elements down to the next one that holds HTML."""
        first = len(self.stack)
        while self.stack[first - 1].inner:
            first -= 1
        self.cut(first)


def build(html: str) -> Element:
    """The tree of a page."""
    root = Element("#root")
    opened = Open(root)
    stack = opened.stack

    def add(text: str) -> None:
        if stack[-1].inner != "svg":
            stack[-1].children.append(text)

    at = 0
    while at < len(html):
        m = _TOKEN.search(html, at)
        if m is None:
            add(unescape(html[at:]))
            break
        if m.start() > at:
            add(unescape(html[at:m.start()]))
        at = m.end()
        ending = m[1]
        tag, attributes = (m[2], m[3]) if m[2] else (m[4], m[5])
        if ending:
            ending = ending.lower()
            if ending in ("br", "p") and stack[-1].inner:
                opened.leave()
            if ending == "br":
                stack[-1].children.append(Element("br"))
            elif ending == "p" and not opened.places.get("p"):
                stack[-1].children.append(Element("p"))
            elif ending not in ("html", "body"):
                opened.end(ending)
        elif tag:
            tag = tag.lower()
            if stack[-1].inner and (tag in BREAKS_OUT or tag == "font" and _FONT.search(attributes)):
                opened.leave()
            within = stack[-1].inner
            if not within:
                if tag in CLOSES:
                    opened.close(*CLOSES[tag])
                if tag in PARAGRAPH_ENDS:
                    opened.close({"p"}, SCOPE | {"button"})
                if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                    opened.cut(len(stack) - 1)
                if tag == "body":
                    opened.close({"head"}, set())
            new = Element(tag, attributes, within)
            stack[-1].children.append(new)
            if (within or tag in ("svg", "math")) and attributes.endswith("/") and not _UNQUOTED_END.search(attributes):
                continue
            if tag in RAW and (not within or tag in ("script", "style", "title")):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                text = html[at:stop.start()] if stop else html[at:]
                new.children.append(unescape(text) if tag in ("textarea", "title") else text)
                at = stop.start() if stop else len(html)
                opened.push(new)
            elif tag not in VOID:
                opened.push(new)
        elif stack[-1].inner and m[0].startswith("<![CDATA["):
            stop = html.find("]]>", m.start())
            add(html[m.start() + 9:stop if stop >= 0 else len(html)])
            at = stop + 3 if stop >= 0 else len(html)
    return root


def _width(text: str) -> int:
    """Columns of a fixed-width screen."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Renderer:
    """Lines of visible text; ``gap`` is the number of blank lines due before the next.

    ``tables`` is the number of tables around.  The methods that go down the
    tree are generators of the steps below them, for ``_walk``.
    """

    def __init__(self, tables: int = 0):
        self.tables = tables
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap, self.space, self.mark, self.indent = 0, False, "", ""

    def line(self) -> None:
        """End the current line."""
        if self.parts:
            if self.lines and self.gap:
                self.lines.append("")
            self.lines.append(self.indent[:len(self.indent) - len(self.mark)] + self.mark + "".join(self.parts) if self.mark
                              else self.indent + "".join(self.parts))
            self.parts, self.gap, self.mark = [], 0, ""
        self.space = False

    def blank(self) -> None:
        self.line()
        self.gap = 1

    def text(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.split("\n")
            self.parts.append(first)
            for more in rest:
                self.parts = self.parts if any(self.parts) else [""]
                self.line()
                self.parts = [more]
            if not any(self.parts):
                self.parts = []
            return
        flat = _SPACE.sub(" ", text)
        words = flat.strip(" ")
        if not words:
            self.space = self.space or bool(flat and self.parts)
            return
        if self.parts and (self.space or flat[0] == " "):
            self.parts.append(" ")
        self.parts.append(words)
        self.space = flat[-1] == " "

    def deeper(self, columns: int) -> None:
        if len(self.indent) < WIDEST:
            self.indent += " " * columns

    def apart(self) -> None:
        """What follows on this line is set off by a space."""
        self.space = self.space or bool(self.parts)

    def element(self, e: Element, pre: bool, depth: int):
        tag = e.tag
        if e.hidden:
            return
        if tag == "br":
            self.parts = self.parts or [""]
            self.line()
            return
        if tag == "hr":
            self.blank()
            self.parts = ["---"]
            self.blank()
            return
        if tag == "table" and self.tables < DEPTH:
            self.blank()
            yield self.table(e, depth)
            self.blank()
            return
        if tag in ("td", "th") and self.tables >= DEPTH:
            self.apart()
            yield self.children(e, pre, depth)
            self.apart()
            return
        block = tag in BLOCK or e.apart
        spaced = tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and depth)
        if block:
            self.blank() if spaced else self.line()
        if tag in ("ul", "ol", "menu", "dir"):
            yield self.items(e, pre, depth + 1)
        elif tag in ("dd", "blockquote"):
            before = self.indent
            self.deeper(4)
            yield self.children(e, pre, depth)
            self.line()
            self.indent = before
        else:
            yield self.children(e, pre or tag in ("pre", "xmp", "textarea"), depth)
        if block:
            self.blank() if spaced else self.line()

    def children(self, e: Element, pre: bool, depth: int):
        apart = e.inner == "math" and e.tag in MATH_APART
        for child in e.children:
            if isinstance(child, str):
                self.text(child, pre)
            elif not child.hidden:
                if apart:
                    self.apart()
                yield self.element(child, pre, depth)
                if apart:
                    self.apart()

    def items(self, e: Element, pre: bool, depth: int):
        number = e.start
        for child in e.children:
            if isinstance(child, str):
                self.text(child, pre)
            elif child.tag == "li" and not child.hidden:
                self.line()
                mark = f"{number}. " if e.tag == "ol" else "- "
                number += 1
                before = self.indent
                self.deeper(len(mark))
                self.mark = mark
                yield self.children(child, pre, depth)
                self.line()
                self.mark, self.indent = "", before
            else:
                yield self.element(child, pre, depth)

    def table(self, e: Element, depth: int):
        groups, captions = [[]], []
        _rows(e, groups, captions)
        for caption in captions:
            yield self.children(caption, False, depth)
            self.line()
        grid = []
        for rows in groups:
            until: dict[int, int] = {}  # the row of the group at which a cell from above leaves the column
            for n, row in enumerate(rows):
                cells, column = [], 0
                for cell in row:
                    if cell.hidden:
                        continue
                    while until.get(column, 0) > n:
                        column += 1
                    inner = Renderer(self.tables + 1)
                    yield inner.children(cell, False, 0)
                    inner.line()
                    cells.append((inner.lines or [""], column, cell.span))
                    if cell.rows != 1:
                        until.update(dict.fromkeys(range(column, column + cell.span), n + cell.rows if cell.rows else len(rows)))
                    column += cell.span
                if any(any(x) for x, *_ in cells):
                    grid.append(cells)
        widths = [0] * max((column + span for cells in grid for _, column, span in cells), default=0)
        for cells in grid:
            for lines, column, span in cells:
                if span == 1:
                    widths[column] = max(widths[column], *map(_width, lines))
        left = [0]
        for width in widths:
            left.append(left[-1] + width + 2)
        if sum(len(x) * left[column] for cells in grid for x, column, _ in cells[-1:]) > PADDING:
            left = [0] * len(left)
        for cells in grid:
            for i in range(max(len(x) for x, *_ in cells)):
                out, at = [], 0
                for lines, column, _ in cells:
                    text = lines[i] if i < len(lines) else ""
                    if text:
                        room = max(left[column] - at, 2 if out else 0)
                        out.append(" " * room + text)
                        at += room + _width(text)
                self.parts = ["".join(out).rstrip() or ""]
                self.line()


def _walk(steps) -> None:
    """Run a generator and the ones it yields, each before its next step."""
    todo = [steps]
    while todo:
        step = next(todo[-1], None)
        if step is None:
            todo.pop()
        else:
            todo.append(step)


def _rows(e: Element, groups: list, captions: list) -> None:
    """A table's rows of cells by row group; text and elements between the parts form rows of their own."""
    stray: list = []
    for child in e.children:
        if isinstance(child, str):
            if not child.isspace():
                stray.append(child)
        elif child.hidden or child.tag in ("colgroup", "col"):
            continue
        elif child.tag in ("tbody", "thead", "tfoot"):
            groups.append([])
            _rows(child, groups, captions)
            groups.append([])
        elif child.tag == "caption":
            captions.append(child)
        elif child.tag == "tr":
            row = []
            for c in child.children:
                if isinstance(c, Element) and c.tag in ("td", "th"):
                    row.append(c)
                elif not isinstance(c, str) or not c.isspace():
                    cell = Element("td")
                    cell.children.append(c)
                    row.append(cell)
            groups[-1].append(row)
        else:
            stray.append(child)
    if stray:
        cell = Element("td")
        cell.children = stray
        groups.append([[cell]])


def render(html: str) -> str:
    """The visible text of a page, laid out."""
    out = Renderer()
    _walk(out.children(build(html), False, 0))
    out.line()
    return "\n".join(line.rstrip() for line in out.lines)


def _rendered(batches):
    for batch in batches:
        texts = [None if h is None else render(h) for h in (x.as_py() for x in batch.column(batch.num_columns - 1))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                         names=[*batch.schema.names[:-1], "text"])


def extract_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, text, n_lines, n_chars), a row for each page."""
    ship_code(pages.sparkSession)
    kind = pages.schema[key].dataType.simpleString()
    out = pages.select(key, html).mapInArrow(_rendered, f"`{key}` {kind}, text string")
    lines = F.when(F.col("text") == "", F.lit(0)).otherwise(F.size(F.split("text", "\n", -1)))
    return out.select(key, "text", F.when(F.col("text").isNotNull(), lines).alias("n_lines"),
                      F.char_length("text").alias("n_chars"))
