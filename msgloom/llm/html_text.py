"""Text of web pages as a reader sees it.

A tree builder closes tags that pages leave open; invisible parts are left out; the rest is
laid out in lines: blocks apart, list items with their marks, table cells in columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import Batches, Rows

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title meta link datalist iframe object audio video "
                   "canvas annotation annotation-xml".split())  # fmt: skip
# Parts of a drawing that are not drawn where they stand, or not at all.
UNDRAWN = frozenset("desc defs metadata symbol".split())
# Inputs that show no text of their own.
SILENT_INPUTS = frozenset("hidden password checkbox radio file range color image".split())
# Blocks with a blank line around them, and blocks that only start a line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr menu".split())
BLOCKS = SPACED | frozenset("html body div section article header footer main nav aside address form li dt dd "
                            "figcaption details summary legend caption tr center dir option optgroup "
                            "search hgroup dialog".split())  # fmt: skip
# Which open tags a start tag closes, up to the tags at which the search ends.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
} | {t: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"})
     for t in ("thead", "tbody", "tfoot")}
CLOSES_P = SPACED | frozenset("div section article header footer main nav aside address form center details "
                              "dir search hgroup dialog".split())  # fmt: skip
SCOPE = frozenset("td th table caption button object html template".split())
STYLE_HIDDEN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)", re.I)
BLANK = re.compile(r"[ \t\n\f\r]+")
#: Deeper elements are laid out as if at this depth; no text is lost.
DEEPEST = 150


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class Builder(HTMLParser):
    """Builds the tree; end tags without start are left out, open tags closed at the end."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]

    def _close(self, tags: set[str], until: frozenset | set) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return self._close(tags, until)
            if self.open[i].tag in until:
                return None
        return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        given = {}
        for name, value in attrs:
            given.setdefault(name, value or "")
        if tag == "html":
            return
        if tag == "body" or (tag in BLOCKS and self.open[-1].tag == "head"):
            self._close({"head"}, set())
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if tag in CLOSES_P:
            self._close({"p"}, SCOPE)
        node = Node(tag, given)
        self.open[-1].children.append(node)
        if tag in VOID:
            return
        if len(self.open) < DEEPEST or tag in HIDDEN or hidden(node):
            self.open.append(node)
        else:
            # A leaf marks the element's start; what follows goes to the deepest open one.
            self.open[-1].children[-1] = Node("br" if tag in BLOCKS else "wbr", {})

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag in ("br", "p") and not any(n.tag == tag for n in self.open):
            self.handle_starttag(tag, [])
            if tag == "br":
                return
        ends = {"table"} if tag in ("tr", "td", "th", "tbody", "thead", "tfoot") else (
            SCOPE if tag not in SCOPE else set())
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ends:
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def tree(html: str) -> Node:
    builder = Builder()
    builder.feed(html)
    builder.close()
    conceal(builder.root)
    return builder.root


def conceal(root: Node) -> None:
    """Take out text that is invisible but takes room; elements in it may be visible again."""
    waiting = [(root, True, False)]
    while waiting:
        node, shown, drawing = waiting.pop()
        found = VISIBILITY.findall(node.attrs.get("style", ""))
        shown = found[-1].lower() == "visible" if found else shown
        drawing |= node.tag == "svg"
        if not shown:
            node.children = [c for c in node.children if not isinstance(c, str)]
            node.attrs = node.attrs | {"value": ""}
        if drawing:
            node.children = [c for c in node.children if isinstance(c, str) or c.tag not in UNDRAWN]
        waiting += [(c, shown, drawing) for c in node.children if not isinstance(c, str)]


def hidden(node: Node) -> bool:
    attrs = node.attrs
    return (node.tag in HIDDEN or "hidden" in attrs or bool(STYLE_HIDDEN.search(attrs.get("style", "")))
            or (node.tag == "dialog" and "open" not in attrs))


class Layout:
    """Lines of a block; inline text is gathered until a block or a break ends the line."""

    def __init__(self):
        self.lines: list[str] = []
        self.text: list[str] = []
        self.gap = False

    def inline(self, text: str, kept: bool = False) -> None:
        if kept:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.text.append(first.replace(" ", "\x00").replace("\t", "\x00" * 4))
            for line in rest:
                self.end(always=True)
                self.text.append(line.replace(" ", "\x00").replace("\t", "\x00" * 4))
        else:
            self.text.append(text)

    def end(self, always: bool = False) -> None:
        """End the line at hand; ``always`` keeps an empty one."""
        line = BLANK.sub(" ", "".join(self.text)).strip(" ").replace("\x00", " ").rstrip(" ")
        self.text = []
        if line or always:
            self._add(line)

    def _add(self, line: str) -> None:
        if self.gap and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = False
        self.lines.append(line)

    def block(self, lines: list[str], spaced: bool) -> None:
        self.end()
        self.gap |= spaced
        for line in lines:
            self._add(line)
        self.gap |= spaced and bool(lines)


def number(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"\s*-?\d{1,9}\s*", value, re.A) else default


def lay_out(node: Node, out: Layout, kept: bool) -> None:
    """Add a node's content to the lines of the block it stands in."""
    for child in node.children:
        if isinstance(child, str):
            out.inline(child.replace("\x00", ""), kept)
        elif hidden(child):
            continue
        elif child.tag == "br":
            out.end(always=bool(out.text))
        elif child.tag == "hr":
            out.block([], True)
        elif child.tag == "table":
            out.block(table_lines(child), True)
        elif child.tag in ("td", "th"):
            out.inline(" ")
            lay_out(child, out, kept)
            out.inline(" ")
        elif child.tag in BLOCKS:
            out.block(block_lines(child, kept), child.tag in SPACED)
        elif child.tag == "input":
            if child.attrs.get("type", "text").lower() not in SILENT_INPUTS:
                out.inline(child.attrs.get("value", ""))
        elif child.tag == "q":
            out.inline('"')
            lay_out(child, out, kept)
            out.inline('"')
        else:
            lay_out(child, out, kept or child.tag == "textarea")


def block_lines(node: Node, kept: bool) -> list[str]:
    if node.tag in ("ul", "ol", "menu", "dir"):
        return list_lines(node, kept)
    out = Layout()
    lay_out(node, out, kept or node.tag == "pre")
    out.end()
    lines = out.lines
    if node.tag in ("dd", "blockquote"):
        lines = [f"  {line}" if line else "" for line in lines]
    while lines and not lines[-1]:
        lines.pop()
    return lines


def list_lines(node: Node, kept: bool) -> list[str]:
    """Items with a dash or their number; further lines and inner lists are set in."""
    out = Layout()
    items = [c for c in node.children if not isinstance(c, str) and c.tag == "li" and not hidden(c)]
    step = -1 if "reversed" in node.attrs else 1
    count = number(node.attrs.get("start"), len(items) if step < 0 else 1)
    for child in node.children:
        if isinstance(child, str) or hidden(child):
            if isinstance(child, str):
                out.inline(child.replace("\x00", ""), kept)
            continue
        if child.tag != "li":
            wrapper = Node("div", {})
            wrapper.children = [child]
            out.block([f"  {line}" if line else "" for line in block_lines(wrapper, kept)], False)
            continue
        mark = "- "
        if node.tag == "ol":
            count = number(child.attrs.get("value"), count)
            mark, count = f"{count}. ", count + step
        lines = block_lines(child, kept) or [""]
        pad = " " * len(mark)
        out.block([(mark + lines[0]).rstrip(), *(f"{pad}{x}" if x else "" for x in lines[1:])], False)
    out.end()
    return out.lines


def table_rows(node: Node) -> Iterator[list[Node]]:
    """The visible cells of each row, head first and foot last, as a browser shows them."""
    groups: dict[str, list[Node]] = {"thead": [], "": [], "tfoot": []}
    for child in node.children:
        if not isinstance(child, str) and not hidden(child):
            kind = child.tag if child.tag in ("thead", "tfoot") else ""
            inside = child.children if child.tag in ("thead", "tbody", "tfoot") else [child]
            groups[kind] += [r for r in inside if not isinstance(r, str) and r.tag == "tr" and not hidden(r)]
            loose = [c for c in inside if not isinstance(c, str) and c.tag in ("td", "th") and not hidden(c)]
            if loose:
                row = Node("tr", {})
                row.children = loose
                groups[kind].append(row)
    for rows in groups.values():
        for row in rows:
            yield [c for c in row.children if not isinstance(c, str) and c.tag in ("td", "th") and not hidden(c)]


def table_lines(node: Node) -> list[str]:
    """Captions and stray text first, then rows with cells in columns of one width each."""
    known = ("thead", "tbody", "tfoot", "tr", "td", "th", "colgroup", "col")
    outside = Node("div", {})
    outside.children = [c for c in node.children if isinstance(c, str) or c.tag not in known]
    for part in node.children:  # what stands in a row or row group without a cell
        if not isinstance(part, str) and part.tag in ("thead", "tbody", "tfoot", "tr") and not hidden(part):
            rows = [part] if part.tag == "tr" else [part, *(c for c in part.children if not isinstance(c, str)
                                                            and c.tag == "tr" and not hidden(c))]
            for row in rows:
                stray = [c for c in row.children if isinstance(c, str) or c.tag not in known]
                outside.children += [" ", *stray]
    lines = block_lines(outside, False)
    grid: list[list[tuple[int, int, list[str]]]] = []
    taken: dict[int, int] = {}  # columns that a cell above still covers, and for how many rows
    for cells in table_rows(node):
        row, column = [], 0
        after = {c: n - 1 for c, n in taken.items() if n > 1}
        for cell in cells:
            while taken.get(column, 0):
                column += 1
            across = min(max(number(cell.attrs.get("colspan"), 1), 1), 1000)
            down = min(max(number(cell.attrs.get("rowspan"), 1), 1), 65534)
            content = Layout()
            lay_out(cell, content, False)
            content.end()
            row.append((column, across, content.lines or [""]))
            if down > 1:
                after.update({c: down - 1 for c in range(column, column + across)})
            column += across
        taken = after
        if row:
            grid.append(row)
    width: dict[int, int] = {}
    for row in grid:
        for column, across, content in row:
            if across == 1:
                width[column] = max(width.get(column, 0), *map(len, content))
    for row in grid:
        height = max(len(content) for *_, content in row)
        for k in range(height):
            line = ""
            for column, _, content in row:
                if k < len(content) and content[k]:
                    at = sum(width.get(c, 0) + 2 for c in range(column) if c in width)
                    line = line.ljust(at) if len(line.rstrip()) + 2 <= at or not line else f"{line.rstrip()}  "
                    line += content[k]
            lines.append(line.rstrip())
    while lines and not lines[-1]:
        lines.pop()
    return lines


def page_text(html: str | None) -> str:
    """The visible text of a page; an empty text for null."""
    return "\n".join(block_lines(tree(html or ""), False)).strip("\n")


def _extract(batches: Batches) -> Iterator[pa.RecordBatch]:
    out = Rows(pa.schema([("page_id", pa.int64()), ("text", pa.string())]))
    for batch in batches:
        for page_id, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = page_text(html)
            out.add(page_id, text, weight=len(text))
            yield from out.ready()
    yield from out.rest()


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id and text, one row for each row of ``pages``.

    Null and empty pages give an empty text; null and repeated ids stay; further columns
    are not read; an empty table gives no row. Pages are laid out whole, whatever their
    length; elements nested deeper than 150 levels keep their text and lose their form.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id bigint, text string")
