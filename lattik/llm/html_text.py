"""Layout-aware text of HTML pages.

A tolerant tokenizer feeds a tree builder that implies missing tags (a block ends an open paragraph, an item ends the item
before it, a cell ends a cell, ...). A renderer walks the tree: hidden parts are left out, blocks start on new lines with a
blank line between paragraphs, list items carry their marker and depth, preformatted text keeps its lines, and table cells
are padded to the width of their column.
"""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattik.llm.common import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head title script style template noscript iframe noembed noframes object canvas audio video datalist desc defs metadata annotation annotation-xml".split())
#: Blocks with a blank line around them, and blocks that only start a line.
PARAGRAPHS = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 ul ol dl table figure hr article section".split())
BLOCKS = PARAGRAPHS | frozenset("address aside body center dd details dialog div dt fieldset figcaption footer form header hgroup html legend li main menu nav summary".split())
#: Elements that an open head holds; other start tags end it.
HEAD = frozenset("head title meta link script style base basefont bgsound noscript noframes template".split())
#: Open elements that a start tag closes, up to the elements behind them.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)), "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)),
}
#: Elements that an end tag doesn't close across.
SCOPES = frozenset("table td th caption html body".split())
#: Elements of which one that only holds another, both without attributes, is the same as the inner one alone.
NESTED = frozenset("div span b i font em strong u small big".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


class Node:
    __slots__ = ("name", "attrs", "kids", "again")

    def __init__(self, name: str, attrs: dict[str, str] | None = None):
        self.name, self.attrs, self.kids, self.again = name, attrs or {}, [], 0


def parse(page: str) -> Node:
    """The tree; texts are strings among the children."""
    root = Node("#root")
    stack = [root]
    opened: Counter = Counter()  # names on the stack, so that none is looked for in vain

    def cut(k: int) -> None:
        opened.subtract(n.name for n in stack[k:])
        del stack[k:]

    def close(names: tuple[str, ...], behind: tuple[str, ...]) -> None:
        k = len(stack) - 1
        while k > 0 and any(opened[n] > 0 for n in names) and stack[k].name not in behind:
            if stack[k].name in names:
                cut(k)
            k -= 1

    def add(text: str) -> None:
        if stack[-1].name == "head" and text.strip():
            cut(len(stack) - 1)
        stack[-1].kids.append(text)

    at = deepest = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            add(html.unescape(page[at:]))
            break
        if m.start() > at:
            add(html.unescape(page[at : m.start()]))
        at = max(m.end(), m.start() + 1)
        if m[1]:
            add(m[1])
        if not m[3]:
            continue
        name = m[3].lower()
        if stack[-1].name == "head" and (name == "br" if m[2] else name not in HEAD):
            cut(len(stack) - 1)
        if m[2]:
            if name == "br":
                stack[-1].kids.append(Node("br"))
            elif name == "p" and not opened["p"]:
                stack[-1].kids.append(Node("p"))
            elif name == stack[-1].name and stack[-1].again:
                stack[-1].again -= 1
                if name in BLOCKS:
                    stack[-1].kids.append(Node("div"))  # what follows begins a line
            elif opened[name] > 0:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == name:
                        cut(k)
                        break
                    if stack[k].name in SCOPES and name not in ("table", "tr", "thead", "tbody", "tfoot", "html", "body"):
                        break
            continue
        if name in BLOCKS and name not in ("html", "body"):
            close(("p",), ("table", "td", "th", "li", "button"))
        if name in CLOSES:
            close(*CLOSES[name])
        top = stack[-1]
        if name in NESTED and name == top.name and not top.kids and not top.attrs and not (m[4] or "").strip():
            top.again += 1
            continue
        node = Node(name, {a.lower(): html.unescape(x or y or z or "") for a, x, y, z in _ATTR.findall(m[4] or "")} if m[4] else {})
        stack[-1].kids.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)[^>]*>?", re.I).search(page, at)
            text = page[at : end.start() if end else len(page)]
            node.kids.append(html.unescape(text) if name in ("title", "textarea") else text)
            at = end.end() if end else len(page)
        elif name not in VOID and not (m[4] or "").rstrip().endswith("/"):
            stack.append(node)
            opened[name] += 1
            deepest = max(deepest, len(stack))
    if deepest * 4 + 1000 > sys.getrecursionlimit():  # rendering takes frames on the heap, up to three for each level
        sys.setrecursionlimit(deepest * 4 + 1000)
    return root


def visible(node: Node) -> bool:
    a = node.attrs
    return not (
        node.name in HIDDEN or "hidden" in a or (node.name == "input" and a.get("type", "").lower() == "hidden")
        or ("style" in a and _NO_DISPLAY.search(a["style"]) is not None) or (node.name == "dialog" and "open" not in a)
    )


def shows(node: Node, inherited: bool) -> bool:
    """Whether an element's own text is visible: its ``visibility``, else its parent's."""
    m = _VISIBILITY.search(node.attrs["style"]) if "style" in node.attrs else None
    return m[1].lower() == "visible" if m else inherited


def chosen(node: Node) -> list[Node]:
    """The options of a list that are seen: all of an open list, else the selected or first one."""
    found, todo = [], list(reversed(node.kids))
    while todo:
        kid = todo.pop()
        if isinstance(kid, Node) and visible(kid):
            if kid.name == "option":
                found.append(kid)
            else:
                todo += reversed(kid.kids)
    if "multiple" in node.attrs or node.attrs.get("size", "1") not in ("", "0", "1"):
        return found
    return ([k for k in found if "selected" in k.attrs] or found)[:1]


def width(text: str) -> int:
    """Columns that a text takes; East-Asian wide characters take two."""
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Page:
    """Lines of text; ``gap`` is the number of line ends due before the next text."""

    def __init__(self) -> None:
        self.lines, self.line, self.gap, self.space = [], "", 0, False
        self.indent, self.marker = "", ""

    def brk(self, gap: int) -> None:
        if self.line:
            self.lines.append(self.line.rstrip())
            self.line, self.gap = "", 1
        self.gap = max(self.gap, gap) if self.lines else 0
        self.space = False

    def _open(self) -> None:
        if not self.line:
            self.lines += [""] * (self.gap - 1)
            self.gap = 0
            self.line = self.indent + self.marker
            self.indent, self.marker = self.indent + " " * width(self.marker), ""

    def text(self, s: str) -> None:
        words = _SPACES.sub(" ", s)
        if words == " " or not words:
            self.space = self.space or bool(words)
            return
        fresh = not self.line
        self._open()
        lead = words[0] == " " or self.space
        self.line += ("" if fresh or not lead else " ") + words.strip(" ")
        self.space = words[-1] == " "

    def raw(self, line: str) -> None:
        self._open()
        self.line += line

    def end(self) -> str:
        self.brk(1)
        return "\n".join(self.lines).strip("\n")


def render(node: Node, page: Page | None = None, pre: bool = False, lists: tuple = (), inherited: bool = True) -> str:
    out = page or Page()
    count = 0
    shown = shows(node, inherited)
    for kid in node.kids:
        if isinstance(kid, str):
            if not shown:
                pass
            elif pre:
                for k, line in enumerate(kid.replace("\r\n", "\n").split("\n")):
                    if k:
                        out._open()
                        out.lines.append(out.line.rstrip())
                        out.line, out.gap = "", 1
                    if line:
                        out.raw(line)
            else:
                out.text(kid)
            continue
        if not visible(kid):
            continue
        name = kid.name
        if name == "br":
            out._open() if out.gap < 2 and not out.line and out.lines else None
            out.brk(1)
        elif name == "hr":
            out.brk(2)
        elif name == "img":
            if kid.attrs.get("alt") and shows(kid, shown):
                out.text(kid.attrs["alt"])
        elif name == "input":
            if kid.attrs.get("type", "text").lower() in ("submit", "button", "reset", "text") and kid.attrs.get("value") and shows(kid, shown):
                out.text(kid.attrs["value"])
        elif name == "select":
            for k, option in enumerate(chosen(kid)):
                if k:
                    out.brk(1)
                render(option, out, False, lists, shows(kid, shown))
        elif name == "table":
            out.brk(2)
            for line in table(kid, shows(kid, shown)):
                out._open()
                out.line += line
                out.lines.append(out.line.rstrip())
                out.line, out.gap = "", 1
            out.brk(2)
        elif name == "li":
            count += 1
            kept = out.indent
            out.brk(1)
            out.marker = f"{_start(node) + count - 1}. " if node.name == "ol" else "- "
            render(kid, out, pre, lists, shown)
            out.brk(1)
            out.indent, out.marker = kept, ""
        elif name in ("ul", "ol", "menu"):
            out.brk(1 if lists else 2)
            if out.marker:  # a list that begins its item
                out.indent, out.marker = out.indent + "  ", ""
            render(kid, out, pre, (*lists, name), shown)
            out.brk(1 if lists else 2)
        elif name == "dd":
            kept = out.indent
            out.brk(1)
            out.indent += "  "
            render(kid, out, pre, lists, shown)
            out.brk(1)
            out.indent = kept
        elif name in BLOCKS:
            gap = 2 if name in PARAGRAPHS else 1
            out.brk(gap)
            render(kid, out, pre or name == "pre", lists, shown)
            out.brk(gap)
        else:
            render(kid, out, pre or name == "textarea", lists, shown)
    return out.end() if page is None else ""


def _start(node: Node) -> int:
    try:
        return int(node.attrs.get("start", "1"))
    except ValueError:
        return 1


def table(node: Node, shown: bool = True) -> list[str]:
    """Lines of a table, cells aligned by column; a cell's lines stand below each other, and a cell over several rows or columns leaves theirs empty."""
    captions, rows = [], []
    below: dict[int, int] = {}  # rows that a cell above still takes, by column

    def put(cells: list, lines: list[str], wide: int = 1, deep: int = 1) -> None:
        while below.get(len(cells), 0) > 0:
            below[len(cells)] -= 1
            cells.append([""])
        for k in range(wide):
            if deep > 1:
                below[len(cells)] = deep - 1
            cells.append([""] if k else lines)

    def collect(at: Node, inherited: bool) -> None:
        loose: list = []
        shown = shows(at, inherited)
        for kid in at.kids:
            if isinstance(kid, str):
                if kid.strip():
                    loose.append(kid)
            elif not visible(kid):
                continue
            elif kid.name == "tr":
                cells: list = []
                own = shows(kid, shown)
                for c in kid.kids:
                    if isinstance(c, Node) and c.name in ("td", "th"):
                        if visible(c):
                            put(cells, render(c, inherited=own).split("\n"), _span(c, "colspan", 1000), _span(c, "rowspan", 65534))
                    elif isinstance(c, Node) and visible(c) or isinstance(c, str) and c.strip():
                        box = Node("td")
                        box.kids = [c]
                        put(cells, render(box, inherited=own).split("\n"))
                for k in range(len(cells), 1 + max((k for k, n in below.items() if n > 0), default=-1)):
                    below[k] = max(0, below.get(k, 0) - 1)
                    cells.append([""])
                rows.append(cells)
            elif kid.name in ("thead", "tbody", "tfoot"):
                collect(kid, shown)
                below.clear()
            elif kid.name in ("td", "th"):
                rows.append([render(kid, inherited=shown).split("\n")])
            else:
                loose.append(kid)
        if loose:
            box = Node("caption")
            box.kids = loose
            captions.append(render(box, inherited=shown))

    collect(node, shown)
    rows = [r for r in rows if any(line.strip() for cell in r for line in cell)]
    widths: list[int] = []
    for r in rows:
        for k, cell in enumerate(r):
            w = max(map(width, cell), default=0)
            if k == len(widths):
                widths.append(w)
            widths[k] = max(widths[k], w)
    lines = [line for c in captions if c for line in c.split("\n")]
    for r in rows:
        for i in range(max(len(cell) for cell in r)):
            parts = [cell[i] if i < len(cell) else "" for cell in r]
            lines.append(" | ".join(p + " " * (widths[k] - width(p)) for k, p in enumerate(parts)).rstrip())
    return lines


def _span(cell: Node, name: str, most: int) -> int:
    """Columns or rows of a cell; the standard's bounds, and its 0 for all rows that are left."""
    n = cell.attrs.get(name, "1")
    n = min(most, int(n)) if n.isascii() and n.isdigit() else 1
    return n or (most if name == "rowspan" else 1)


def extract_text(page: str | None) -> str:
    """All visible text of a page; empty for a null or empty one."""
    return render(parse(page)) if page else ""


def title(page: str | None) -> str | None:
    """The first title's text."""
    m = re.search(r"<title[^>]*>(.*?)(?:</title|$)", page or "", re.S | re.I)
    return _SPACES.sub(" ", html.unescape(m[1])).strip() if m else None


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col``, ``title``, ``text``, ``n_chars``, ``n_lines`` for each whole page.

    A null or empty page has an empty text and no title; broken markup is read as far as it goes; repeated rows are
    rendered each; very long and very deep pages are read whole; an empty table gives no rows; other columns are not read.
    """

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            source = batch.column(1).to_pylist()
            texts = [extract_text(p) for p in source]
            cols = [pa.array([title(p) for p in source], pa.string()), pa.array(texts, pa.string())]
            cols += [pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())]
            return pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[id_col, "title", "text", "n_chars", "n_lines"])

        return run

    schema = f"`{id_col}` {dict(pages.dtypes)[id_col]}, title string, text string, n_chars bigint, n_lines bigint"
    return map_batches(pages.select(F.col(id_col), F.col(html_col)), make, schema)
