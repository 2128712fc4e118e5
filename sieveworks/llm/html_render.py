"""HTML to text as it would be laid out: a tree builder, visibility rules and a block renderer."""

from __future__ import annotations

import html as entities
import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, small

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe noembed noframes".split())
PLAIN = frozenset("textarea title xmp".split())
UNSEEN = frozenset("head title base link meta script style template noembed noframes iframe object audio video canvas svg datalist area param source track".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul caption tr xmp".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul menu dir hr xmp".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt xmp".split())
HEAD_ONLY = frozenset("base link meta script style template title noscript".split())
TABLE_PARTS = {"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}

#: An opened element first closes those of the first set that stand above the nearest one of the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "caption": ({"caption", "colgroup"}, {"table"}),
    "colgroup": ({"caption", "colgroup"}, {"table"}),
}

# The deepest nesting that browsers build, and the standard's largest spans.
DEPTH, SPAN, ROWS = 512, 1000, 65534

#: A line of a table cell that is longer stands out of its column, and the columns that a cell or gap spans count for no more together, besides their bars.
COLUMN = 256

_MARKUP = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</?([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?([A-Za-z][^\s/>]*)([^>]*)>|</[^A-Za-z>][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?\s*(?=;|\Z)")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if "=" in text or text.strip(" /\n\t\r"):
        for m in _ATTRIBUTE.finditer(text):
            value = m[2] or m[3] or m[4] or ""
            found.setdefault(m[1].lower(), entities.unescape(value) if "&" in value else value)
    return found


class TreeBuilder:
    """Tags to a tree, with the end tags and table rows that authors leave out."""

    def __init__(self):
        self.root = Node("html", {})
        self.stack = [self.root]
        self.count: dict[str, int] = {}

    def build(self, source: str) -> Node:
        at, n = 0, len(source)
        while at < n:
            m = _MARKUP.search(source, at)
            if m is None:
                self.text(source[at:])
                break
            if m.start() > at:
                self.text(source[at : m.start()])
            at = m.end()
            name = m[1] or m[3]
            if name is None:
                if m[0].startswith("<![CDATA["):
                    self.text(m[0][9:].removesuffix("]]>"), decode=False)
                continue
            name = name.lower()
            if source[m.start() + 1] == "/":
                self.close(name)
                continue
            self.open(name, m[2] if m[1] else m[4])
            if name in RAW or name in PLAIN:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                body = source[at : end.start() if end else n]
                at = end.end() if end else n
                if body and name in PLAIN:
                    self.text(body, decode=name != "xmp")
                self.close(name)
        return self.root

    def text(self, text: str, decode: bool = True) -> None:
        if decode and "&" in text:
            text = entities.unescape(text)
        if "head" in self.count and self.stack[-1].tag == "head" and text.strip():
            self.close("head")
        self.stack[-1].children.append(text)

    def push(self, node: Node, void: bool = False) -> None:
        self.stack[-1].children.append(node)
        if not void and len(self.stack) < DEPTH:
            self.stack.append(node)
            self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack.pop().tag
            if self.count[tag] == 1:
                del self.count[tag]
            else:
                self.count[tag] -= 1

    def above(self, tags, scope) -> int | None:
        """The lowest place on the stack of an element of tags that no element of scope stands above."""
        found = None
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k].tag
            if tag in tags:
                found = k
            elif tag in scope:
                break
        return found

    def open(self, name: str, raw: str) -> None:
        count = self.count
        if name in ("html", "body"):
            if "head" in count:
                self.close("head")
            extra = _attributes(raw)
            for k, v in extra.items():
                self.root.attrs.setdefault(k, v)
            return
        if name == "head" and ("head" in count or len(self.stack) > 1):
            return
        if "head" in count and name not in HEAD_ONLY:
            self.close("head")
        if name in CLOSES_P and "p" in count and (k := self.above({"p"}, {"button", "table", "td", "th", "caption", "object"})) is not None:
            self.pop_to(k)
        if name[0] == "h" and len(name) == 2 and name[1] in "123456" and re.fullmatch("h[1-6]", self.stack[-1].tag):
            self.pop_to(len(self.stack) - 1)
        if (rule := IMPLIED.get(name)) and any(t in count for t in rule[0]) and (k := self.above(*rule)) is not None:
            self.pop_to(k)
        if name in ("td", "th") and "table" in count and self.stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.push(Node("tr", {}))
        if name == "table" and self.stack[-1].tag == "table":
            self.pop_to(len(self.stack) - 1)
        self.push(Node(name, _attributes(raw) if raw else {}), void=name in VOID)

    def close(self, name: str) -> None:
        if name in ("br", "p") and name not in self.count:
            self.stack[-1].children.append(Node(name, {}))
            return
        if name not in self.count:
            return
        scope = () if name in ("table", "body", "html") else {"table"} if name in TABLE_PARTS else {"td", "th", "caption", "table"}
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == name:
                self.pop_to(k)
                return
            if self.stack[k].tag in scope:
                return


class Lines:
    """Lines of text under construction: white space collapses, blocks end lines, margins become one blank line."""

    def __init__(self):
        self.done: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.margin = False
        self.fresh = False
        self.lists = 0
        self.first, self.rest = "", ""

    def text(self, text: str, pre: bool) -> None:
        if pre:
            head, *more = text.expandtabs(8).replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.put(head)
            for line in more:
                self.line(force=True)
                self.put(line)
            return
        text = _SPACE.sub(" ", text)
        if text == " ":
            self.space = bool(self.now)
            return
        if not text:
            return
        if self.space or text[0] == " ":
            if self.now and not self.now[-1].endswith(" "):
                self.now.append(" ")
            text = text.lstrip(" ")
        self.space = text[-1] == " "
        self.put(text.rstrip(" "))

    def put(self, text: str) -> None:
        if text:
            self.now.append(text)

    def line(self, force: bool = False) -> None:
        """Ends the line that was begun; force: an empty one too."""
        if self.now or force:
            self.emit("".join(self.now).rstrip(" "))
        self.now, self.space = [], False

    def emit(self, text: str) -> None:
        if self.margin and self.done:
            self.done.append(self.rest.rstrip(" "))
        self.margin = self.fresh = False
        self.done.append((self.first + text).rstrip(" ") if text or self.first.strip() else self.rest.rstrip(" "))
        self.first = self.rest

    def block(self, spaced: bool) -> None:
        self.line()
        self.margin |= spaced and not self.fresh

    def enter(self) -> None:
        """A block with marks begins: the margin before it stands outside, and none follows the mark."""
        if self.margin and self.done:
            self.done.append(self.rest.rstrip(" "))
        self.margin, self.fresh = False, True


#: What a value of visibility does to the text; others, and those that ask for the parent's, leave it.
SETS = {"visible": True, "initial": True, "hidden": False, "collapse": False}


def _declared(style: str) -> dict[str, str]:
    """The last value of display and visibility that a style declares by that very name; important ones go before others."""
    said: dict[str, tuple[bool, str]] = {}
    for name, value, important in _STYLE.findall(_COMMENT.sub(" ", style.lower())):
        if important or not said.get(name, (False, ""))[0]:
            said[name] = bool(important), value
    return {name: value for name, (_, value) in said.items()}


def _hidden(node: Node) -> tuple[bool, bool | None]:
    """Whether the element makes no box at all, and the visibility that it sets for its text, if any."""
    a = node.attrs
    if node.tag in UNSEEN or "hidden" in a or node.tag == "input" and a.get("type", "").lower() == "hidden" or node.tag == "dialog" and "open" not in a:
        return True, None
    if "style" in a:
        said = _declared(a["style"])
        if said.get("display") == "none":
            return True, None
        return False, SETS.get(said.get("visibility"))
    return False, None


class Renderer:
    def render(self, node: Node, out: Lines, shown: bool, pre: bool, ordinal: int | None) -> None:
        gone, sets = _hidden(node)
        if gone:
            return
        shown = shown if sets is None else sets
        tag = node.tag
        if tag == "br":
            if shown:
                out.line(force=True)
            return
        if tag == "hr":
            out.block(True)
            out.emit("-" * 8)
            out.block(True)
            return
        if tag == "input":
            if shown and node.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                out.text(node.attrs.get("value", ""), False)
            return
        block = tag in BLOCK
        nested = tag in ("ul", "ol", "menu", "dir")
        spaced = tag in SPACED and not (nested and out.lists)
        out.lists += nested
        if block:
            out.block(spaced)
        if tag == "table":
            self.table(node, out, shown)
        elif tag == "li" or tag in ("blockquote", "dd"):
            mark = ("- " if ordinal is None else f"{ordinal}. ") if tag == "li" and shown else "> " if tag == "blockquote" else "    "
            out.enter()
            first, rest = out.first, out.rest
            out.first, out.rest = rest + mark, rest + ("> " if tag == "blockquote" else " " * len(mark))
            before = len(out.done)
            self.children(node, out, shown, pre)
            out.line()
            if len(out.done) == before:
                out.first = first
            else:
                out.first = rest
            out.rest = rest
        else:
            self.children(node, out, shown, pre or tag in ("pre", "textarea", "listing", "xmp"))
        out.lists -= nested
        if block:
            out.fresh &= tag not in ("li", "blockquote", "dd")
            out.block(spaced)

    def children(self, node: Node, out: Lines, shown: bool, pre: bool) -> None:
        number = None
        if node.tag == "ol":
            start = node.attrs.get("start", "1")
            number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
        skip = pre and node.tag == "pre"
        for child in node.children:
            if isinstance(child, str):
                if shown:
                    out.text(child[1:] if skip and child.startswith("\n") else child, pre)
            elif number is not None and child.tag == "li":
                value = child.attrs.get("value", "")
                number = int(value) if re.fullmatch(r"-?\d{1,9}", value) else number
                self.render(child, out, shown, pre, number)
                number += 1
            else:
                self.render(child, out, shown, pre, None)
            skip = False

    def table(self, node: Node, out: Lines, shown: bool) -> None:
        """Captions and strays as blocks, then the rows with their cells in aligned columns."""
        rows, groups = [], {"thead": [], "": [], "tfoot": []}
        strays, stack = [], [(c, "", shown) for c in reversed(node.children)]
        while stack:
            c, group, seen = stack.pop()
            if isinstance(c, str):
                if c.strip():
                    strays.append((c, seen))
                continue
            gone, sets = _hidden(c)
            if gone or c.tag in ("col", "colgroup"):
                continue
            see = seen if sets is None else sets
            if c.tag in ("thead", "tbody", "tfoot"):
                stack += [(x, c.tag if c.tag in groups else "", see) for x in reversed(c.children)]
            elif c.tag == "tr":
                groups[group].append((c, see))
            else:
                strays.append((c, seen))
        for c, seen in strays:
            if isinstance(c, str):
                if seen:
                    out.text(c, False)
            else:
                self.render(c, out, seen, False, None)
        out.line()
        taken: dict[tuple[int, int], bool] = {}
        for part in ("thead", "", "tfoot"):
            rows += groups[part]
        grid, widths = [], {}
        for r, (row, seen) in enumerate(rows):
            cells, col = [], 0
            for c in row.children:
                if isinstance(c, str):
                    if not c.strip():
                        continue
                    c, text = Node("td", {}), c
                    c.children.append(text)
                gone, sets = _hidden(c)
                if gone:
                    continue
                while taken.pop((r, col), False):
                    col += 1
                inner = Lines()
                self.children(c, inner, seen if sets is None else sets, False) if c.tag in ("td", "th") else self.render(c, inner, seen, False, None)
                inner.line()
                span, down = (min(most, int(v)) if re.fullmatch(r"[1-9]\d{0,8}", v := c.attrs.get(k, "1")) else 1 for k, most in (("colspan", SPAN), ("rowspan", ROWS)))
                for d in range(1, min(down, len(rows) - r)):
                    taken.update({(r + d, col + k): True for k in range(span)})
                cells.append((col, span, inner.done or [""], c.attrs.get("align", "").lower()))
                if span == 1:
                    widths[col] = max(widths.get(col, 0), max((n for n in map(len, inner.done) if n <= COLUMN), default=0))
                col += span
            grid.append(cells)
        for cells in grid:
            if not any(line.strip() for *_, lines, _ in cells for line in lines):
                continue
            for k in range(max(len(lines) for *_, lines, _ in cells)):
                parts, col = [], 0
                for at, span, lines, align in cells:
                    left = COLUMN
                    while col < at:
                        parts.append(" " * min(left, widths.get(col, 0)))
                        left -= len(parts[-1])
                        col += 1
                    width = min(COLUMN, sum(widths.get(at + j, 0) for j in range(span))) + 3 * (span - 1)
                    text = lines[k] if k < len(lines) else ""
                    parts.append(text.rjust(width) if align == "right" else text.center(width) if align == "center" else text.ljust(width))
                    col = at + span
                out.emit(" | ".join(parts).rstrip(" "))


def render(source: str | None) -> str:
    """The visible text of a page, laid out; empty for null."""
    if not source:
        return ""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * DEPTH))
    out = Lines()
    Renderer().render(TreeBuilder().build(source), out, True, False, None)
    out.line()
    return "\n".join(out.done).replace("\xa0", " ").strip("\n")


def rendered(pages: DataFrame, *, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id, text, n_chars and n_lines of every page.

    Text is kept if it makes a box: not in head, scripts, styles, templates,
    media and the like, nor below hidden, display:none, or visibility:hidden or
    collapse unless set visible again; other declarations change nothing.  Blocks start lines, margins of paragraphs, lists,
    tables and headings are one blank line, list items carry marks or numbers
    and hanging indents, table cells are padded into columns (spans included) of
    up to COLUMN characters, whatever the table's size, longer lines stand out of
    theirs, pre keeps its white space.
    Whole pages are read, however long, each in memory; elements nested over 512
    deep become siblings, as in browsers, with their text kept.  Null and empty
    pages give an empty text; repeated rows are rendered each; a null id stays
    null; other columns, whatever their names, are ignored; an empty table gives
    no rows.
    """

    def scan(batches):
        for batch in small(batches, "html"):
            texts = [render(h) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], names=["page_id", "text", "n_chars", "n_lines"])

    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(html).cast("string").alias("html")).mapInArrow(scan, "page_id long, text string, n_chars long, n_lines long")


def op2_html_layout(spark, sf_dir: str) -> DataFrame:
    """The laid-out text of every page."""
    return rendered(read_table(spark, sf_dir, "pages"))
