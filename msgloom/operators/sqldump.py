"""Rows of SQL dump text: tuple lines to columns by expressions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.functions.text import clean_line
from msgloom.operators.shape import compute_once

# One value after its comma: a quoted text with '' or backslash escapes, or a bare word.
# Possessive loops: a text of any length is matched without backtracking or recursion.
TUPLE_VALUE = r"(?s),(\s*+'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'\s*+|[^',]*+)(?=,|$)"
HEADER_LINE = r"^\(\s*`[^`]+`\s*(?:,\s*`[^`]+`\s*)*\)?[,;]?$"
# A whole tuple of such values, and a line of one or more with an optional end.
_VALUE = r"(?:\s*+(?:'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'|[^',()]*+)\s*+)"
TUPLE = rf"\({_VALUE}(?:,{_VALUE})*+\)"
TUPLE_LINE = rf"(?s)^{TUPLE}(?:\s*+,\s*+{TUPLE})*+\s*+[,;]?$"
# What may stand before the tuples of a line, and lines that hold no data at all.
STATEMENT = r"(?is)^insert\s+(?:ignore\s+)?into\s+[^\s(]+\s*(?:\([^()']*\)\s*)?values\s*"
NO_DATA = (
    r"(?is)^(?:insert\s+(?:ignore\s+)?into\s+[^\s(']+\s*(?:\([^()']*\))?\s*(?:values)?|values|"
    r"--.*|/\*.*\*/;?)$"
)
# Escapes of one letter; any other escaped character stands for itself.
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "b": "\b", "Z": "\x1a"}


def tuple_body(line: Column) -> Column:
    """What stands between the outer brackets of a tuple line."""
    text = clean_line(line)
    return F.substr(text, F.lit(2), F.length(text) - 3)


def strip_tuple(line: Column) -> Column:
    """The tuple without brackets and quotes (the mixed-file form)."""
    return F.translate(tuple_body(line), "'", "")


def _literals(line: Column) -> Column:
    body = F.concat(F.lit(","), tuple_body(line))
    return F.regexp_extract_all(body, F.lit(TUPLE_VALUE), F.lit(1))


def _plain_value(literal: Column) -> Column:
    text = F.trim(literal)
    inner = F.replace(
        F.substr(text, F.lit(2), F.length(text) - 2), F.lit("''"), F.lit("'")
    )
    unescaped = F.when(inner.contains("\\"), _unescaped(inner)).otherwise(inner)
    is_null = F.upper(text) == "NULL"
    return F.when(text.startswith("'"), unescaped).when(is_null, F.lit("")).otherwise(text)


def _unescaped(text: Column) -> Column:
    """Backslash escapes resolved; between doubled backslashes each one starts an escape."""

    def part(piece: Column) -> Column:
        for letter, char in ESCAPES.items():
            piece = F.replace(piece, F.lit(f"\\{letter}"), F.lit(char))
        return F.replace(piece, F.lit("\\"), F.lit(""))

    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def tuple_values(line: Column) -> Column:
    """Values of a tuple: quotes resolved, NULL as the empty text."""
    return F.transform(_literals(line), _plain_value)


def header_predicate(line: Column) -> Column:
    """Whether a line is a tuple of back-ticked names."""
    return clean_line(line).rlike(HEADER_LINE)


def tuple_header(lines: DataFrame, line: str = "value") -> list[str] | None:
    """Names from the first header line; only that one line comes to the driver."""
    names = F.regexp_extract_all(F.col(line), F.lit(r"`\s*([^`]+?)\s*`"), F.lit(1))
    found = lines.filter(header_predicate(F.col(line))).select(names.alias("names")).head(1)
    return list(found[0]["names"]) if found else None


def read_tuples(
    lines: DataFrame,
    columns: list[str],
    line: str = "value",
    keep: Sequence[str] = (),
    aside: Column | None = None,
) -> DataFrame:
    """One row per tuple or line that holds none: line, literals and reason (null if it fits).

    A record over several lines that is no list of tuples, as behind a stray quote, is taken
    line by line. Rows that ``aside`` marks come out as they are, without literals or reason.
    Columns in ``keep`` stay.
    """
    aside = F.lit(False) if aside is None else aside

    # Each pattern is tried only on texts that begin like it or hold its sign.
    def holds_no_data(text: Column) -> Column:
        begins = F.substr(text, F.lit(1), F.lit(1)).isin("i", "I", "v", "V", "-", "/")
        header = text.contains("`") & text.rlike(HEADER_LINE)
        return (text == "") | header | (begins & text.rlike(NO_DATA))

    def tuples_of(text: Column) -> Column:
        insert = F.lower(F.substr(text, F.lit(1), F.lit(6))) == "insert"
        return F.when(insert, F.regexp_replace(text, STATEMENT, "")).otherwise(text)

    def judged(rows: DataFrame, line: str, where: Column, suffix: str) -> DataFrame:
        """With the clean text, its tuples if it holds data, and whether they are whole."""
        text, body = f"_text{suffix}", f"_body{suffix}"
        rows = compute_once(rows, text, F.when(where, clean_line(F.col(line))))
        has_data = F.coalesce(~holds_no_data(F.col(text)), F.lit(False))
        rows = compute_once(rows, body, F.when(has_data, tuples_of(F.col(text))))
        return compute_once(rows, f"_whole{suffix}", F.col(body).rlike(TUPLE_LINE))

    given = lines.select(*keep, aside.alias("_aside"), F.col(line).alias("_value"))
    first = judged(given, "_value", ~F.col("_aside"), "1")
    torn = F.col("_value").contains("\n") & F.col("_body1").isNotNull() & ~F.col("_whole1")
    marked = first.withColumn("_torn", F.coalesce(torn, F.lit(False)))
    pieces = F.when(F.col("_torn"), F.split("_value", "\n")).otherwise(F.array("_value"))
    # Only the lines of torn ones are judged again.
    apart = judged(marked.select("*", F.explode(pieces).alias("line")), "line", F.col("_torn"), "2")
    apart = apart.select(
        *keep, "_aside", "line",
        *[F.when(F.col("_torn"), F.col(f"_{c}2")).otherwise(F.col(f"_{c}1")).alias(f"_{c}")
          for c in ("text", "body", "whole")],
    )
    body = apart.filter(F.col("_aside") | F.col("_body").isNotNull())
    text, readable = F.col("_text"), F.col("_whole")
    tuples = F.when(readable, F.regexp_extract_all("_body", F.lit(f"({TUPLE})"), F.lit(1))).otherwise(
        F.array(F.lit(None).cast("string"))
    )
    one = compute_once(body, "_tuples", tuples).select(
        *keep, "_aside", "line", "_text", F.explode("_tuples").alias("_tuple"), (F.size("_tuples") == 1).alias("_alone")
    )
    inner = F.substr(F.col("_tuple"), F.lit(2), F.length("_tuple") - 2)
    found = F.regexp_extract_all(F.concat(F.lit(","), inner), F.lit(TUPLE_VALUE), F.lit(1))
    read = compute_once(one, "literals", found)
    fits = F.col("_tuple").isNotNull() & (F.size("literals") == len(columns))
    count = F.size("literals").cast("string")
    reason = (
        F.when(F.col("_aside") | fits, F.lit(None).cast("string"))
        .when(F.col("_tuple").isNotNull(), F.concat(count, F.lit(f" values for {len(columns)} columns")))
        .when(text.startswith("("), F.lit("unreadable value"))
        .otherwise(F.lit("no tuple"))
    )
    part = F.when(F.col("_alone"), F.col("line")).otherwise(F.col("_tuple"))
    return read.select(*keep, part.alias("line"), "literals", reason.alias("reason"))


def rows_and_rejects(read: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Data rows with named text columns, and the rejects, of what ``read_tuples`` gave."""
    fits = F.col("reason").isNull() & F.col("literals").isNotNull()
    good = read.filter(fits).select(
        *[_plain_value(F.get("literals", F.lit(i))).alias(c) for i, c in enumerate(columns)]
    )
    return good, read.filter(F.col("reason").isNotNull()).select("line", "reason")


def parse_tuples(
    lines: DataFrame, columns: list[str], line: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Data rows with named text columns, and what does not fit, with a reason.

    A line holds one tuple or several, with or without a statement before them and a comma
    or semicolon after. Blank lines, headers, statement heads and comments hold no data;
    every other line goes to the rows or to the rejects. A tuple fits when there is a value
    for every column; each one that does not fit is a reject of its own.
    """
    return rows_and_rejects(read_tuples(lines, columns, line), columns)
