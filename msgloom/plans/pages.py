"""Stored web pages to roster and listing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgloom.functions.text import cell
from msgloom.operators import classify, grid, rows
from msgloom.sinks import writers

# Positions of the cells in a row, from 0.
ROSTER_CELLS = {"Last Name": 2, "First Name": 3, "Contact Phone": 7, "Email": 8}
ROSTER_WIDTH = 9
LISTING_CELLS = {"MLS ID": 3, "Address": 6, "City": 8, "Price": 10}
# Classes of the rows that are people and listings.
ROSTER_CLASS = "singleLineDisplay"
LISTING_CLASS = "DisplayRegRow"


def _found(pages: DataFrame, row_class: str | None, **patterns: str) -> DataFrame:
    """Table rows by a fold over the tags, or by patterns where the markup is another."""
    if not patterns:
        return grid.grid_rows(pages, row_class=row_class, keep=["page_id"])
    if row_class:
        patterns = {"row_pattern": rows.row_of_class(row_class), **patterns}
    return rows.extract_html_rows(pages, keep=["page_id"], **patterns)


def roster_rows(
    pages: DataFrame, row_class: str | None = ROSTER_CLASS, **patterns: str
) -> DataFrame:
    """People from the rows of a class; shorter rows are left out. Without a class, all rows."""
    found = _found(pages, row_class, **patterns)
    full = classify.row_shape_filter(found, "cells", ROSTER_WIDTH)
    return full.select(
        "page_id",
        "row_number",
        *[F.get("cells", F.lit(i)).alias(name) for name, i in ROSTER_CELLS.items()],
    )


def listing_rows(
    pages: DataFrame, row_class: str | None = LISTING_CLASS, **patterns: str
) -> DataFrame:
    """Listings from the rows of a class, ``N/A`` for a cell that is not there."""
    found = _found(pages, row_class, **patterns)
    return found.filter(F.size("cells") > LISTING_CELLS["MLS ID"]).select(
        "page_id",
        "row_number",
        *[cell(F.col("cells"), i).alias(name) for name, i in LISTING_CELLS.items()],
    )


def write_rows(found: DataFrame, path: str) -> bool:
    """The rows as CSV, nothing where there are none."""
    return writers.guard_empty(
        found.drop("page_id", "row_number"), lambda df: writers.write_csv(df, path)
    )
