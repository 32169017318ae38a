"""Expressions on small values, checked against plain Python."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from msgloom import config
from msgloom.functions import messages, numbers, times
from msgloom.functions import text as X


def one(spark, column, schema="x STRING", *values):
    """The column's value on one row of the given values."""
    return spark.createDataFrame([values or (None,)], schema).select(column.alias("out")).first()[0]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("(555) 010-0001", "+15550100001"),
        ("15550100001", "+15550100001"),
        ("+1 555 010 0001", "+15550100001"),
        ("1155", "+1155"),
        ("1", "+1"),
        ("", ""),
        ("abc", None),
        (None, None),
    ],
)
def test_us_phone(spark, given, expected):
    assert one(spark, X.us_phone(F.col("x")), "x STRING", given) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [("true", True), ("True", False), ("false", False), ("yes", False), ("", False), (None, None)],
)
def test_text_true(spark, given, expected):
    assert one(spark, X.text_true(F.col("x")), "x STRING", given) is expected


def test_text_true_takes_a_flag(spark):
    assert one(spark, X.text_true(F.col("x")), "x BOOLEAN", True) is True


def test_strip_template(spark):
    strip = X.strip_template(F.col("x"))
    assert one(spark, strip, "x STRING", "Hi {{ first name }}, {{x}}{{}} {y}") == "Hi , {{}} {y}"
    assert one(spark, strip) == ""


def test_join_or_default(spark):
    join = X.join_or_default(F.col("x"), "ALL")
    kind = "x ARRAY<STRING>"
    assert one(spark, join, kind, ["a", None, "b"]) == "a,b"
    assert one(spark, join, kind, []) == ""
    assert one(spark, join, kind, None) == "ALL"


def test_lang_text(spark):
    kind = "x MAP<STRING, STRING>"
    assert one(spark, X.lang_text(F.col("x")), kind, {"en": "a", "de": "b"}) == "a"
    assert one(spark, X.lang_text(F.col("x")), kind, {"de": "b"}) is None
    assert one(spark, X.lang_text(F.col("x")), kind, None) is None


def test_row_id_is_stable_and_null_safe(spark):
    ids = [one(spark, X.row_id(F.col("x"), F.lit(1)), "x STRING", v) for v in ("a", "a", None, "")]
    assert ids[0] == ids[1] and len(set(ids)) == 3
    parts = [F.get(F.split("x", ","), F.lit(i)) for i in (0, 1)]
    clash = [one(spark, X.row_id(*parts), "x STRING", v) for v in ("a|,b", "a,|b")]
    assert clash[0] != clash[1]


def test_random_id_differs_per_row(spark):
    assert spark.range(50).select(X.random_id().alias("id")).distinct().count() == 50


def test_log_key_and_identity(spark):
    assert one(spark, X.log_key(F.lit("S1"), F.col("x")), "x STRING", "++155") == "S1-155"
    assert one(spark, X.identity(F.col("x")), "x STRING", "+155") == "agent:+155"


def test_cell(spark):
    kind = "x ARRAY<STRING>"
    assert one(spark, X.cell(F.col("x"), 1), kind, ["a", "b"]) == "b"
    assert one(spark, X.cell(F.col("x"), 2), kind, ["a", "b"]) == "N/A"


def test_clean_line_and_plain_text(spark):
    assert one(spark, X.clean_line(F.col("x")), "x STRING", " \t a b \r\n") == "a b"
    html = ' <b class="x">a &lt; b</b> &amp;lt; '
    assert one(spark, X.plain_text(F.col("x")), "x STRING", html) == "a < b &lt;"


def test_json_leaves_null_fields_out(spark):
    both = F.struct(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"))
    assert one(spark, X.json_of(both)) == '{"a":1}'


def test_times(spark):
    assert one(spark, times.epoch_to_ts(F.col("x")), "x BIGINT", 86400) == dt.datetime(1970, 1, 2)
    assert one(spark, times.epoch_to_ts(F.col("x")), "x BIGINT", None) is None
    day = times.event_date(F.col("q"), F.col("c"), "2024-02-01")
    kind = "q BIGINT, c BIGINT"
    assert one(spark, day, kind, 0, 86400) == dt.date(1970, 1, 1)
    assert one(spark, day, kind, None, 86400) == dt.date(1970, 1, 2)
    assert one(spark, day, kind, None, None) == dt.date(2024, 2, 1)
    assert one(spark, times.date_prefix(F.col("x")), "x STRING", "2025-11-01T10") == dt.date(
        2025, 11, 1
    )
    assert one(spark, times.date_prefix(F.col("x")), "x STRING", "unknown") is None
    run = times.run_dates(dt.datetime(2024, 3, 1, 5))
    assert one(spark, run["yesterday"]) == dt.date(2024, 2, 29)
    assert one(spark, run["run_date"]) == "20240301"


def test_numbers(spark):
    kind = "a INT, b INT"
    a, b = F.col("a"), F.col("b")
    assert one(spark, numbers.counter(a, b), kind, None, 3) == 3
    assert one(spark, numbers.pct(a, b), kind, 1, 3) == 33.33
    assert one(spark, numbers.pct(a, b), kind, 1, 0) == 0.0
    assert one(spark, numbers.pct(a, b), kind, 1, None) == 0.0
    assert str(one(spark, numbers.cost(a, 0.09), kind, 3, None)) == "0.2700"
    assert one(spark, numbers.cost(a, 0.09, "float"), kind, 3, None) == pytest.approx(0.27)


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9] * 200
    sums = {
        spark.createDataFrame([(v,) for v in order], "x DOUBLE")
        .repartition(parts)
        .agg(numbers.exact_sum(F.col("x")))
        .first()[0]
        for order, parts in ((values, 1), (values[::-1], 7), (sorted(values), 3))
    }
    assert sums == {120.0}


# --- message texts -----------------------------------------------------------------
def flags(*on):
    return {s: F.lit(s in on) for s in config.SLOTS}


def test_first_slot_follows_priority(spark):
    pick = messages.first_true_slot(flags("sunday_evening", "saturday_midday"))
    assert one(spark, pick) == "Saturday - Midday"
    assert one(spark, messages.first_true_slot(flags())) == "Weekdays - Afternoon"


def test_unknown_flag_counts_as_unset(spark):
    unset = {s: F.lit(None).cast("boolean") for s in config.SLOTS}
    assert one(spark, messages.first_true_slot(unset)) == "Weekdays - Afternoon"
    assert "flexible" in one(spark, messages.availability_sentence(unset))


@pytest.mark.parametrize(
    ("on", "expected"),
    [
        ((), "I've shared that your availability is flexible."),
        (("weekdays_morning",), "I've shared that you're available weekday mornings (6am-10am)."),
        (
            ("weekdays_morning", "sunday_evening"),
            "I've shared that you're available weekday mornings (6am-10am) or Sunday evenings "
            "(6pm-9pm).",
        ),
        (
            ("weekdays_morning", "saturday_midday", "sunday_evening"),
            "I've shared that you're available weekday mornings (6am-10am), Saturday mid-days "
            "(10am-2pm) or Sunday evenings (6pm-9pm).",
        ),
    ],
)
def test_availability_sentence(spark, on, expected):
    assert one(spark, messages.availability_sentence(flags(*on))) == expected


def text_of(spark, name, beds="3", baths="2"):
    lit = F.lit
    return one(
        spark,
        messages.appointment_text(
            lit(name), lit("Ann Lee"), lit("+1555"), lit("1 Road"), lit("Saturday - Midday"),
            lit(beds), lit(baths),
        ),
    )


def test_appointment_text(spark):
    assert text_of(spark, "Bo") == (
        "Hi Bo, congratulations.\nI'm connecting you with Ann Lee, who'll be helping you with "
        "your cash offer. His phone number is +1555.\n\nAnn Lee will visit your property at "
        "1 Road on Saturday - Midday and can often deliver an offer within 24 hours."
        "\nProperty: 3 Beds / 2 Baths"
    )
    assert text_of(spark, None).startswith("Hi, congratulations.")
    assert "Property:" not in text_of(spark, "Bo", beds="")
    assert "Property:" not in text_of(spark, "Bo", baths=None)


def test_introduction_text(spark):
    said = F.lit("S.")
    text = one(spark, messages.introduction_text(F.lit(""), F.lit("Ann"), said, "just 24 hours"))
    assert text.startswith("Congratulations! I'm connecting you with Ann, ")
    assert "within just 24 hours." in text
    assert text.endswith('Please reply "Yes" to confirm you\'ve received this message.')
    assert one(spark, messages.introduction_text(F.lit("Bo"), F.lit("Ann"), said)).startswith(
        "Hi Bo, Congratulations!"
    )


def test_agent_and_internal_text(spark):
    lit = F.lit
    agent = one(
        spark,
        messages.agent_text(lit("Ann Lee"), lit("Bo"), lit("1 Road"), lit("98"), lit("3"), lit("2"),
                            lit("Slot")),
    )
    assert agent.startswith("Hi Ann,\n\nYou've got a cash offer appointment scheduled with Bo at")
    assert re.search(r"Beds / 2 Baths\nAppointment Window: Slot\n\nPlease text", agent)
    office = one(
        spark,
        messages.internal_text(lit("Bo"), lit("+1"), lit("1 Road"), lit("98"), lit("Ann"),
                               lit("+2"), lit("Slot")),
    )
    assert office == (
        "New appointment confirmed.\nBo (+1)\n1 Road, 98\nAgent: Ann \nPhone: (+2)\nTime: Slot."
    )


def test_friendly_name_falls_back_to_the_phone(spark):
    for name, expected in (("Bo", "Bo"), ("", "+1"), (None, "+1")):
        title = messages.friendly_name(F.col("x"), F.lit("+1"), F.lit("Ann"))
        assert one(spark, title, "x STRING", name) == f"Conversation between {expected} and Ann"
