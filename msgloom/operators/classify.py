"""Filters, splits and classifications: row-wise, inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom import config
from msgloom.functions.text import clean_line, filled


def filter_in(df: DataFrame, code: str | Column, codes: Sequence[str]) -> DataFrame:
    """Rows whose code is in the list; a null code is not."""
    return df.filter((F.col(code) if isinstance(code, str) else code).isin(*codes))


status_allow_list = filter_in


def not_bot(flag: Column) -> Column:
    """True unless the flag is true; a missing flag is no bot."""
    return ~F.coalesce(flag, F.lit(False))


def drop_bots(df: DataFrame, flag: str, where: Column | None = None) -> DataFrame:
    """Rows without bot traffic; ``where`` narrows the test to some rows (clicks)."""
    keep = not_bot(F.col(flag))
    if where is not None:
        keep = keep | ~F.coalesce(where, F.lit(False))
    return df.filter(keep)


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the predicate, and all others (an unknown one goes there too)."""
    met = F.coalesce(predicate, F.lit(False))
    return df.filter(met), df.filter(~met)


def map_codes(code: Column, names: Mapping[str, str], default: str) -> Column:
    """Name of a code, the default for an unknown or missing one."""
    pairs = iter(names.items())
    first, name = next(pairs)
    chain = F.when(code == first, name)
    for value, name in pairs:
        chain = chain.when(code == value, name)
    return chain.otherwise(default)


def map_status(event: Column, statuses: Mapping[str, str] = config.EVENT_STATUSES) -> Column:
    return map_codes(event, statuses, config.OTHER_STATUS)


def map_direction(event: Column, inbound: Sequence[str] = config.INBOUND_EVENTS) -> Column:
    """``MO`` for events the customer starts, else ``MT``."""
    return F.when(event.isin(*inbound), "MO").otherwise("MT")


def classify_channel(email: Column, sms: Column) -> Column:
    """Channel of a notification; a missing flag counts as unset."""
    return F.when(email, "EMAIL").when(sms, "SMS").otherwise("PUSH_NOTIFICATION")


def delivery_status(canceled: Column, completed: Column) -> Column:
    return (
        F.when(canceled, "CANCELED")
        .when(completed.isNotNull(), "COMPLETED")
        .otherwise("IN_PROGRESS")
    )


def choose_by_code(code: Column, codes: Sequence[str], chosen: Column, other: Column) -> Column:
    """One of two columns, by whether the code is in the list."""
    return F.when(code.isin(*codes), chosen).otherwise(other)


def has_link(urls: Sequence[Column], text: Column) -> Column:
    """1 where any address is given or the text holds one, else 0."""
    test = text.contains("http")
    for url in urls:
        test = url.isNotNull() | test
    return F.when(test, 1).otherwise(0)


def link_shortened(url: Column) -> Column:
    """YES or NO by pattern; null without an address."""
    return F.when(url.rlike(config.SHORT_LINK), "YES").when(url.isNotNull(), "NO")


def missing_fields(columns: Sequence[str]) -> Column:
    """Names of the columns that are null or empty."""
    return F.array_compact(F.array(*[F.when(~filled(F.col(c)), F.lit(c)) for c in columns]))


def require_fields(
    df: DataFrame, columns: Sequence[str], reason: str = "reason"
) -> tuple[DataFrame, DataFrame]:
    """Rows with every field filled, and the others with the reason."""
    missing = missing_fields(columns)
    valid = df.filter(F.size(missing) == 0)
    invalid = df.withColumn("_missing", missing).filter(F.size("_missing") > 0)
    text = F.concat(F.lit("Missing required fields: "), F.array_join("_missing", ", "))
    return valid, invalid.withColumn(reason, text).drop("_missing")


def row_shape_filter(df: DataFrame, cells: str, at_least: int) -> DataFrame:
    """Rows with enough cells."""
    return df.filter(F.size(cells) >= at_least)


def listing_search(
    df: DataFrame,
    between: Mapping[str, tuple[object, object]] | None = None,
    equal: Mapping[str, object] | None = None,
    prefix: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows within inclusive ranges, with given values, and with given beginnings.

    All three become scan filters.
    """
    for name, (low, high) in (between or {}).items():
        df = df.filter(F.col(name).between(low, high))
    for name, value in (equal or {}).items():
        df = df.filter(F.col(name) == value)
    for name, beginning in (prefix or {}).items():
        df = df.filter(F.col(name).startswith(beginning))
    return df


def sql_tuple_predicate(line: Column) -> Column:
    """Whether a line is one row of an INSERT: ``( … ),`` or ``( … );``."""
    text = clean_line(line)
    return text.startswith("(") & (text.endswith("),") | text.endswith(");"))
