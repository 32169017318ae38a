"""Unions, ordering, sampling and operators that make several rows of one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.functions.text import plain_text

# Defaults for table markup. Heading cells are no data.
TABLE_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
TABLE_CELL = r"(?is)<td\b[^>]*>(.*?)</td>"


def row_of_class(name: str, tag: str = "tr") -> str:
    """Pattern of the rows that have a class among theirs."""
    given = rf"""class\s*=\s*(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>]))"""
    return rf"(?is)<{tag}\b[^>]*?\b{given}[^>]*>(.*?)</{tag}>"


def outer_tables(html: Column) -> Column:
    """The page with rows and cells of tables within tables renamed, so that patterns pass them.

    The page is cut at the table tags; the depth is counted from cut to cut.
    """
    pieces = F.split(html, r"(?i)(?=<table\b|</table\s*>)")
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"(?i)^<table\b"), piece.rlike(r"(?i)^</table\b")
        depth = state["depth"] + F.when(opens, 1).when(closes & (state["depth"] > 0), -1).otherwise(0)
        inner = F.regexp_replace(piece, r"(?i)<(/?)t([rdh])\b", "<$1inner-t$2")
        kept = F.when(depth > 1, inner).otherwise(piece)
        return F.struct(depth.alias("depth"), F.concat(state["out"], F.array(kept)).alias("out"))

    return F.array_join(F.aggregate(pieces, start, step, lambda s: s["out"]), "")


def recombine(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, matched by column name, repeats kept."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def conversation_log(sent: DataFrame, replies: DataFrame) -> DataFrame:
    """Sent messages and replies as one log; a field one side lacks is null there."""
    return sent.unionByName(replies, allowMissingColumns=True)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, to look at."""
    return df.limit(n)


def first_row(df: DataFrame, *order: str | Column) -> DataFrame:
    """The first row in an order (a top-1, not a full sort)."""
    return df.orderBy(*order).limit(1)


def time_sorted(df: DataFrame, ts: str, *tie: str) -> DataFrame:
    """Rows in time order.

    The tie columns also let the range partitioning cut through one moment that holds
    very many rows.
    """
    return df.orderBy(ts, *tie)


def per_recipient_rows(
    df: DataFrame, recipients: Sequence[str], into: str = "recipient_number"
) -> DataFrame:
    """One row per recipient column; the recipient columns are replaced by the number."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in recipients]
    return df.select(*kept, F.explode(F.array(*[F.col(r) for r in recipients])).alias(into))


def extract_html_rows(
    pages: DataFrame,
    html: str = "html",
    row_pattern: str = TABLE_ROW,
    cell_pattern: str = TABLE_CELL,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per repeating piece of markup, with its number on the page and its cells.

    Each pattern has one group. Text of a table within a cell stays in that cell. Nothing is
    shuffled: a page's rows stay in its task.
    """
    nested = F.col(html).rlike(r"(?is)<table\b.*<table\b")
    whole = F.when(nested, outer_tables(F.col(html))).otherwise(F.col(html))
    raw = F.regexp_extract_all(whole, F.lit(row_pattern), F.lit(1))
    found = pages.select(*keep, F.posexplode(raw).alias("row_number", "_row"))
    cells = F.regexp_extract_all(F.col("_row"), F.lit(cell_pattern), F.lit(1))
    return found.withColumn("cells", F.transform(cells, plain_text)).drop("_row")


def explode_platform_stats(
    df: DataFrame, stats: str = "platform_delivery_stats", keep: Sequence[str] = ("id",)
) -> DataFrame:
    """One row per platform with its counters."""
    return df.select(*keep, F.explode(stats).alias("platform", "_stats")).select(
        *keep, "platform", "_stats.*"
    )
