"""Text, map, array and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom import config


def lang_text(texts: Column, lang: str = "en") -> Column:
    """The text for a language key; null for a missing key or map."""
    return texts[lang]


def join_or_default(items: Column, default: str, sep: str = ",") -> Column:
    """Items joined by a separator, or the default where there is no list at all."""
    return F.when(items.isNotNull(), F.concat_ws(sep, items)).otherwise(F.lit(default))


def json_of(value: Column) -> Column:
    """JSON text of a struct or map; null fields are left out, null stays null."""
    return F.to_json(value)


def parse_json(text: Column, schema: T.DataType) -> Column:
    """Struct from JSON text; null where the text does not fit."""
    return F.from_json(text, schema)


def first_non_null(*cols: Column) -> Column:
    return F.coalesce(*cols)


def strip_template(text: Column) -> Column:
    """Text without its ``{{marks}}``; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), config.TEMPLATE_MARK, "")


def row_id(*keys: Column) -> Column:
    """Stable id of a row: the same keys give the same id on every run and retry.

    Each key goes in with its length, a null as a sign of its own, so that no two lists of
    keys read the same.
    """
    texts = [k.cast("string") for k in keys]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def random_id() -> Column:
    """Fresh id per row. Not repeatable: a retried task gives other ids."""
    return F.uuid()


def us_phone(text: Column) -> Column:
    """``+1`` and the digits without one leading 1.

    Empty and null pass through; a text without digits gives null.
    """
    digits = F.regexp_replace(text, r"[^0-9]", "")
    return (
        F.when(text == "", text)
        .when(digits == "", F.lit(None))
        .otherwise(F.concat(F.lit("+1"), F.regexp_replace(digits, "^1", "")))
    )


def text_true(value: Column) -> Column:
    """True for a true flag or exactly the text ``true``; null stays null."""
    return value.cast("string") == "true"


def filled(value: Column) -> Column:
    """Whether a text holds something (neither null nor empty)."""
    return F.coalesce(value.cast("string") != "", F.lit(False))


def log_key(sid: Column, phone: Column) -> Column:
    """Key of a logged message: id and recipient number without plus signs."""
    return F.concat(sid, F.lit("-"), F.translate(phone, "+", ""))


def identity(phone: Column) -> Column:
    """Chat identity of an agent."""
    return F.concat(F.lit("agent:"), phone)


def cell(cells: Column, index: int, default: str = "N/A") -> Column:
    """The cell at a position (from 0), or the default where the row is shorter."""
    return F.coalesce(F.get(cells, F.lit(index)), F.lit(default))


def clean_line(line: Column) -> Column:
    """Line without leading and trailing white space."""
    return F.btrim(line, F.lit(" \t\r\n\f\v"))


def plain_text(html: Column) -> Column:
    """Markup without tags, with the common entities resolved and blanks trimmed."""
    text = F.regexp_replace(html, "<[^>]*>", "")
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&nbsp;", " "),
        ("&amp;", "&"),
    ):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(text)
