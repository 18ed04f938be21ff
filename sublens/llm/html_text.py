"""HTML to text with its layout: block spacing, lists, aligned table cells.

A page's tags are read into a tree in which missing tags are implied (a block
closes an open paragraph, an item or cell closes its neighbour, a cell without a row
opens one, a closing tag closes what is still open inside).  Rendering walks the tree, leaves out what a
browser does not show (head, scripts, styles, templates, elements that are
hidden by their own attribute or style; a visible child of an invisible element is shown), collapses white space outside ``pre``, puts blocks on lines of their
own with a blank line around paragraphs, headings, lists and tables, marks list items
by nesting and number, and pads table cells so that columns line up, beside cells that span rows too.  The end tag of an
inline element does not close a block that is open inside it.  A table with anything
shown outside its rows' cells and captions is rendered like any other block.

Nothing is recursive, so depth is no limit; open tags are found by name, so time is linear in the page.  Defined cases: NULL and empty pages give an empty text; a tag
without an end is text; unknown tags are inline; text outside any element is
shown; repeated rows are repeated; NULL ids are kept.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTR = re.compile(
    r"(?P<name>[^ \t\n\f\r/>][^ \t\n\f\r/=>]*+)"
    r"(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:\"(?P<d>[^\"]*+)\"|'(?P<s>[^']*+)'|(?P<u>[^ \t\n\f\r>\"'][^ \t\n\f\r>]*+)))?")
MAY_HIDE = re.compile("hidden|style", re.I)
CSS_OTHER = re.compile(r"/\*.*?(?:\*/|\Z)|\"[^\"]*+\"|'[^']*+'|\([^()]*+\)", re.S)      # comments, strings, arguments
COLSPAN = re.compile(r"\s*(\d{1,3})")
ROWSPAN = re.compile(r"\s*(\d{1,5})")
START = re.compile(r"\s*(-?\d{1,9})")
SPACE = re.compile(r"[ \t\r\n\f]+")

# Fixed values of the HTML standard, by element name.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
NOT_SHOWN = frozenset("head script style title template noscript iframe noembed noframes datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
BLOCKS = SPACED | frozenset(
    "html body div article section nav aside header footer main address center details dialog dd dt fieldset "
    "figcaption form hgroup hr li menu search summary legend caption tr thead tbody tfoot option".split())
# a start tag closes these open elements, up to the nearest element that bounds the search
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("td", "th", "tr", "caption", "colgroup"),
    "td": ("td", "th", "caption", "colgroup"), "th": ("td", "th", "caption", "colgroup"),
    "tbody": ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"),
    "thead": ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"),
    "tfoot": ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"),
    "caption": ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"),
    "colgroup": ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"),
    "body": ("head",),
}
BOUNDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"},
          "optgroup": {"select"}, "body": {"html"}}
CLOSES_P = BLOCKS - {"html", "body", "summary", "legend", "caption", "tr", "thead", "tbody", "tfoot", "option", "li", "dt", "dd"}
GROUPS = frozenset("table thead tbody tfoot".split())
# where a table's parts stand; one elsewhere makes it no plain table
PARENTS = {"tr": GROUPS, "thead": GROUPS, "tbody": GROUPS, "tfoot": GROUPS, "caption": GROUPS,
           "td": {"tr"}, "th": {"tr"}, "colgroup": {"table"}, "col": {"table", "colgroup"}}
WALLS = BLOCKS | {"td", "th", "button"}
ENDS_CELLS = frozenset("table tr tbody thead tfoot body html".split())
P_BOUNDS = {"td", "th", "caption", "button", "table", "html", "body", "li", "div", "blockquote", "article", "section"}


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs = tag, attrs
        self.kids: list[Node | str] = []


def build(page: str) -> Node:
    root = Node("#root")
    stack = [root]
    places: dict[str, list[int]] = defaultdict(list)       # of the open elements of a name, in the stack
    blocks: list[int] = []                                 # of the open blocks and cells

    def push(node: Node) -> None:
        places[node.tag].append(len(stack))
        if node.tag in WALLS:
            blocks.append(len(stack))
        stack.append(node)

    def pop_to(size: int) -> None:
        while len(stack) > size:
            tag = stack.pop().tag
            places[tag].pop()
            if tag in WALLS:
                blocks.pop()

    def nearest(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(tags, bounds) -> None:
        """Pop up to and with the outermost of ``tags`` above a bound."""
        above = nearest(bounds)
        cuts = [p[i] for t in tags if (p := places.get(t)) and (i := bisect.bisect_right(p, above)) < len(p)]
        if cuts:
            pop_to(min(cuts))

    at = 0
    while True:
        m = TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            stack[-1].kids.append(html.unescape(text))
        if not m:
            return root
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            i = nearest((tag,))
            if not i or i < nearest(("table", "td", "th")) and tag not in ENDS_CELLS:
                continue                               # a stray end tag does not leave its cell
            if tag not in WALLS and blocks and blocks[-1] > i and shown(stack[i]):
                continue                               # nor does an inline one end a block inside
            pop_to(i)
            continue
        if tag in ("html", "body") and places.get(tag):
            continue
        if tag in CLOSES:
            close(CLOSES[tag], BOUNDS.get(tag, {"table"}))
        if tag in CLOSES_P:
            close(("p",), P_BOUNDS)
            if tag not in ("head", "html") and len(stack) > 1 and stack[-1].tag == "head":
                pop_to(len(stack) - 1)
        if tag in ("td", "th") and stack[-1].tag in GROUPS:
            row = Node("tr")
            stack[-1].kids.append(row)
            push(row)
        node = Node(tag, m["attrs"])
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            inner = page[at:end.start() if end else len(page)]
            node.kids.append(html.unescape(inner) if tag in ("title", "textarea") else inner)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m["attrs"].endswith("/") or tag in BLOCKS and tag not in VOID:
            push(node)


class Lines:
    """Collects text into lines: white space collapsed, breaks merged."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False            # a collapsed space is waiting
        self.blank = False            # a blank line is waiting
        self.indent, self.mark = 0, ""

    def text(self, t: str) -> None:
        t = SPACE.sub(" ", t)
        if self.now and t[:1] == " ":
            self.space = True
        t_ = t.strip(" ")
        if t_:
            self._open()
            if self.space and self.now:
                self.now.append(" ")
            self.now.append(t_)
            self.space = t[-1] == " "
        elif t:
            self.space = bool(self.now)

    def _open(self) -> None:
        if not self.now and not self.space:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False

    def stop(self) -> None:
        if self.now:
            self.raw("".join(self.now))
        self.now, self.space = [], False

    def raw(self, line: str) -> None:
        mark, self.mark = self.mark, ""
        pad = " " * (self.indent - len(mark)) + mark if self.indent else mark
        self.lines.append((pad + line).rstrip(" "))

    def gap(self) -> None:
        self.stop()
        self.blank = True

    def literal(self, line: str) -> None:
        """A line with its spaces."""
        self.stop()
        self._open()
        self.raw(line)


def attributes(raw: str) -> dict[str, str]:
    """Values by name in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for m in ATTR.finditer(raw):
        out.setdefault(m["name"].lower(), html.unescape(m["d"] or m["s"] or m["u"] or ""))
    return out


def _looks(raw: str) -> tuple[bool, str]:
    """Not displayed by the attribute hidden or by the style, and the style's visibility.  The last word
    of a property counts unless an earlier one is important."""
    if not MAY_HIDE.search(raw):
        return False, ""
    found = attributes(raw)
    style: dict[str, tuple[str, bool]] = {}
    for part in CSS_OTHER.sub(" ", found.get("style", "")).lower().split(";"):
        name, _, value = part.partition(":")
        value, bang, _ = value.partition("!")
        name, value = name.strip(), value.strip()
        if value and (bang or not style.get(name, ("", False))[1]):
            style[name] = (value, bool(bang))
    display = style.get("display", ("",))[0]
    return display == "none" or not display and "hidden" in found, style.get("visibility", ("",))[0]


def shown(node: Node) -> bool:
    return node.tag not in NOT_SHOWN and not (node.attrs and _looks(node.attrs)[0]) and not (
        node.tag == "input")


def visible(node: Node, around: bool) -> bool:
    """Whether the node's own text is seen; if its style does not say, as around it."""
    word = _looks(node.attrs)[1] if node.attrs else ""
    return True if word in ("visible", "initial") else False if word in ("hidden", "collapse") else around


class Cell(NamedTuple):
    text: str
    columns: int
    rows: int                     # 0: all that are left in its part of the table


def _cell(node: Node, seen: bool) -> Cell:
    found = attributes(node.attrs) if node.attrs else {}
    columns, rows = COLSPAN.match(found.get("colspan", "")), ROWSPAN.match(found.get("rowspan", ""))
    return Cell(" ".join(render(node, visible(node, seen)).split()), max(1, int(columns[1])) if columns else 1,
                int(rows[1]) if rows else 1)


def table_rows(table: Node, seen: bool = True) -> tuple[list[tuple[Node, list[Cell]]], list[str]]:
    """(part of the table, cells) of each row, in order; and the captions."""
    rows, captions, todo = [], [], [(table, seen, table)]
    while todo:
        n, seen, part = todo.pop()
        if n.tag == "tr":
            rows.append((part, [_cell(k, seen) for k in n.kids
                                if isinstance(k, Node) and k.tag in ("td", "th") and shown(k)]))
        elif n.tag == "caption":
            captions.append(" ".join(render(n, seen).split()))
        else:
            todo += [(k, visible(k, seen), n) for k in reversed(n.kids) if isinstance(k, Node) and shown(k)
                     and k.tag in ("tr", "thead", "tbody", "tfoot", "caption")]
    return rows, captions


def _only_cells(table: Node) -> bool:
    """No shown text outside the cells and captions that table_rows finds, and no
    table inside (that would be layout)."""
    todo = [(k, "table") for k in table.kids]          # with the tag around it, or none inside a cell
    while todo:
        n, around = todo.pop()
        if isinstance(n, str):
            if around and n.strip():
                return False
        elif shown(n):
            if n.tag == "table" or around and around not in PARENTS.get(n.tag, ()):
                return False
            todo += [(k, around and n.tag not in ("td", "th", "caption") and n.tag) for k in n.kids]
    return True


def _table_lines(table: Node, seen: bool) -> list[str]:
    rows, out = table_rows(table, seen)
    placed: list[list[tuple[int, Cell]]] = []
    widths: dict[int, int] = {}
    taken: dict[int, float] = {}           # column -> rows that a cell from above still covers
    part = None
    for now, row in rows:
        if now is not part:
            part, taken = now, {}
        at, places, below = 0, [], {}
        for cell in row:
            while at in taken:
                at += 1
            places.append((at, cell))
            if cell.columns == 1:
                widths[at] = max(widths.get(at, 0), len(cell.text))
            if cell.rows != 1:
                below.update(dict.fromkeys(range(at, at + cell.columns), cell.rows - 1 if cell.rows else math.inf))
            at += cell.columns
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | below
        placed.append(places)
    for places in placed:
        line, end = [], 0
        for at, cell in places:
            line += [" " * widths.get(i, 0) for i in range(end, at)]
            end = at + cell.columns
            line.append(cell.text.ljust(sum(widths.get(i, 0) for i in range(at, end)) + 2 * (cell.columns - 1)))
        out.append("  ".join(line).rstrip())
    return [x for x in out if x]


def _first_number(items: Node) -> tuple[int, int]:
    """Number of a list's first item, and the step to the next."""
    found = attributes(items.attrs) if items.attrs else {}
    m, step = START.match(found.get("start", "")), -1 if "reversed" in found else 1
    if m:
        return int(m[1]), step
    return 1 if step > 0 else sum(isinstance(k, Node) and k.tag == "li" and shown(k) for k in items.kids), step


def render(root: Node, seen: bool = True) -> str:
    """The shown text of a tree, whose root's own text is seen or not."""
    out = Lines()
    lists: list[list] = []                 # open lists: [number or None, indent outside, step]
    todo: list[tuple[Node | str, str, bool]] = [(root, "in", seen)]
    pre = 0
    while todo:
        n, way, seen = todo.pop()
        if isinstance(n, str):
            if not seen:
                continue
            if pre:
                parts = n.replace("\r\n", "\n").split("\n")
                for i, line in enumerate(parts):
                    if line:
                        out._open()
                        out.now.append(line)
                    if i < len(parts) - 1:
                        if out.now:
                            out.stop()
                        elif out.lines and not out.blank:
                            out.lines.append("")
            else:
                out.text(n)
            continue
        tag = n.tag
        if way == "out":
            if tag == "pre":
                pre -= 1
            if tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1):
                out.gap()
            elif tag in BLOCKS:
                out.stop()
            if tag in ("ul", "ol", "menu"):
                out.indent = lists.pop()[1]
            elif tag == "li" and out.mark:             # an empty item
                out.mark = ""
            elif tag in ("td", "th"):
                out.space = bool(out.now)
            continue
        if not shown(n):
            continue
        if n is not root and n.attrs:
            seen = visible(n, seen)
        if tag == "br":
            if out.now:
                out.stop()
            elif out.lines and not out.blank:
                out.lines.append("")
            continue
        if tag == "table" and n is not root and _only_cells(n):
            out.gap()
            for line in _table_lines(n, seen):
                out.literal(line)
            out.gap()
            continue
        if tag in SPACED and not (tag in ("ul", "ol") and lists):
            out.gap()
        elif tag in BLOCKS:
            out.stop()
        if tag == "pre":
            pre += 1
        elif tag in ("ul", "ol", "menu"):
            number, step = _first_number(n) if tag == "ol" else (None, 0)
            lists.append([number, out.indent, step])
        elif tag == "li":
            number = lists[-1][0] if lists else None
            if number is not None and n.attrs and (m := START.match(attributes(n.attrs).get("value", ""))):
                number = int(m[1])
            mark = "- " if number is None else f"{number}. "
            if lists and number is not None:
                lists[-1][0] = number + lists[-1][2]
            out.indent = (lists[-1][1] if lists else 0) + len(mark)
            out.mark = mark if seen else ""
        todo.append((n, "out", seen))
        todo += [(k, "in", seen) for k in reversed(n.kids)]
    out.stop()
    while out.lines and not out.lines[-1]:
        out.lines.pop()
    return "\n".join(out.lines)


def page_text(page: str | None) -> str:
    return render(build(page)) if page else ""


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """pages with the shown text of ``html_col`` in ``out_col``; the other
    columns stay (one named like out_col is replaced), the html goes."""
    keep = [c for c in pages.columns if c not in (html_col, out_col)]
    src = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html_col).alias(out_col))
    schema = src.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                text = [page_text(x.as_py()) for x in b.column(b.num_columns - 1)]
                yield b.set_column(b.num_columns - 1, b.schema.field(b.num_columns - 1), pa.array(text, pa.string()))

    return src.mapInArrow(run, schema)
