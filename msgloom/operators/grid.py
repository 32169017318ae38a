"""Rows of HTML tables by position: a fold over the tags, linear in the page.

End tags may be left out, comments and scripts hold no cells, and a cell that spans columns
or rows takes all its places in the grid.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgloom.functions.text import plain_text

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)(table|thead|tbody|tfoot|tr|td|th)\b((?:[^>"']|"[^"]*"|'[^']*')*)>""",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
# The most columns and rows that a cell can span.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), next((v for v in values if v), ""))
    return found


def _span(given: dict[str, str], name: str, most: int) -> int:
    digits = re.match(r"\s*(\d+)", given.get(name, ""))
    return min(int(digits[1]), most) if digits else 1


class Fold:
    """Rows of the outer tables of one page, each with its class names and cells in place."""

    def __init__(self, html: str):
        self.html, self.rows = html, []
        self.row: tuple[set[str], list] | None = None
        self.cell: list | None = None  # [pieces of markup, start of the next, columns, rows, data]
        self.inner = 0  # tables open within the cell
        self.spans: dict[int, list] = {}  # column: rows left, markup
        for token in TOKEN.finditer(html):
            self._take(token)
        self._close_row(len(html))

    def _take(self, token: re.Match) -> None:
        tag, at = (token[3] or "").lower(), token.start()
        if not tag:  # a comment or a script
            if self.cell:
                self.cell[0].append(self.html[self.cell[1] : at])
                self.cell[1] = token.end()
        elif self.inner:
            self.inner += (1 if not token[2] else -1) if tag == "table" else 0
        elif tag in ("td", "th"):
            self._close_cell(at)
            if not token[2]:
                self.row = self.row or (set(), [])
                given = attributes(token[4])
                columns = max(1, _span(given, "colspan", MOST_COLUMNS))
                self.cell = [[], token.end(), columns, _span(given, "rowspan", MOST_ROWS), tag == "td"]
        elif tag == "table" and not token[2] and self.cell:
            self.inner = 1
        else:
            self._close_row(at)
            if tag != "tr":
                self.spans = {}  # spans end with their table or part of it
            elif not token[2]:
                self.row = (set(attributes(token[4]).get("class", "").split()), [])

    def _close_cell(self, at: int) -> None:
        if self.cell:
            pieces, start, columns, rows, data = self.cell
            if data:  # heading cells are no data
                text = "".join([*pieces, self.html[start:at]])
                self.row[1].append((text, columns, rows or MOST_ROWS))
        self.cell, self.inner = None, 0

    def _close_row(self, at: int) -> None:
        self._close_cell(at)
        if not self.row:
            return
        classes, cells = self.row
        placed: dict[int, str] = {}
        coming: dict[int, list] = {}
        for column, (left, text) in self.spans.items():
            placed[column] = text
            if left > 1:
                coming[column] = [left - 1, text]
        column = 0
        for text, columns, rows in cells:
            while column in self.spans:
                column += 1
            for place in range(column, column + columns):
                placed.setdefault(place, text)
                if rows > 1:
                    coming.setdefault(place, [rows - 1, text])
            column += columns
        width = max(placed, default=-1) + 1
        self.rows.append((classes, [placed.get(c, "") for c in range(width)]))
        self.row, self.spans = None, coming


def page_rows(html: str | None, row_class: str | None = None) -> list[list[str]]:
    """Cells of each row as markup; with a class those of its rows only."""
    found = Fold(html or "").rows
    return [cells for classes, cells in found if row_class is None or row_class in classes]


def grid_rows(
    pages: DataFrame, html: str = "html", row_class: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per table row, with its number on the page and its cells by grid position.

    Rows of a table within a cell are text of that cell. A cell's text stands at every place
    that it spans. Heading cells are no data and take no place. A null page has no rows. The
    pages stay in their tasks.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                made = [page_rows(page, row_class) for page in part.column(0).to_pylist()]
                source = pa.array([i for i, rows in enumerate(made) for _ in rows], pa.int32())
                numbers = [n for rows in made for n in range(len(rows))]
                cells = [c for rows in made for c in rows]
                kept = [column.take(source) for column in part.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(numbers, pa.int32()), pa.array(cells, pa.list_(pa.string()))],
                    names=[*batch.schema.names[1:], "row_number", "_cells"],
                )

    given = pages.select(F.col(html).alias("_html"), *keep)
    kinds = dict(given.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "row_number int", "_cells array<string>"])
    found = given.mapInArrow(read, schema)
    return found.withColumn("cells", F.transform("_cells", plain_text)).drop("_cells")
