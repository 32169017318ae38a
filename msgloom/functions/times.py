"""Date and time expressions (session zone UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

When = Column | dt.datetime | dt.date | str


def moment(value: When) -> Column:
    """A timestamp column from a column, a Python time or an ISO text."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds as a typed timestamp; null stays null."""
    return F.timestamp_seconds(seconds)


def event_date(queued: Column, completed: Column, as_of: When) -> Column:
    """Day a message was queued, else completed, else the run day."""
    return F.to_date(F.coalesce(epoch_to_ts(queued), epoch_to_ts(completed), moment(as_of)))


def date_prefix(text: Column) -> Column:
    """The date in the first ten characters; null when they hold none."""
    return text.substr(1, 10).try_cast("date")


def date_parts(ts: Column) -> dict[str, Column]:
    """Folder texts ``year``, ``month`` and ``day`` of a time."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def run_dates(as_of: When) -> dict[str, Column]:
    """Run day, the day before and after, and the run-day text used for folders."""
    day = F.to_date(moment(as_of))
    return {
        "run_date": F.date_format(day, "yyyyMMdd"),
        "today": day,
        "yesterday": F.date_sub(day, 1),
        "tomorrow": F.date_add(day, 1),
    }
