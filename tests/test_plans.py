"""What the plans of the main operators look like: pruning, pushdown and shuffles."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    """The physical plan of a query, with joins as they are for big tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield lambda name: queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("filter_codes", "In(event_type, [click,view])"),
        ("day_window", "GreaterThanOrEqual(ts,"),
        ("since_cursor", "GreaterThan(ts,"),
        ("listing_search", "StringStartsWith(p_name,s)"),
        ("listing_search", "GreaterThanOrEqual(p_size,5)"),
        ("reply_projection", "EqualTo(role,user)"),
    ],
)
def test_filters_reach_the_scan(plan, name, pushed):
    found = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(name))
    assert found and all(pushed in f for f in found), found


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("count_by", "event_type"),
        ("filter_codes", "event_id event_type"),
        ("next_cursor", "ts"),
        ("latest_per_key", "o_orderkey o_custkey o_orderdate"),
        ("html_rows", "page_id html"),
        ("campaign_kpis", "l_suppkey l_returnflag"),
    ],
)
def test_only_the_columns_needed_are_read(plan, name, columns):
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan(name)):
        assert {c.split(":")[0] for c in schema.split(",")} == set(columns.split())


@pytest.mark.parametrize(
    "name",
    ["props_flatten", "payload_errors", "pack_unmapped", "conform_unified", "html_rows",
     "sql_tuple_parse", "mixed_lines", "template_strip", "link_flags", "lead_normalise",
     "render_messages", "reply_projection", "reply_conversation",
     "message_events_raw", "notifications_raw", "platform_stats_rows"],
)
def test_row_wise_work_moves_no_rows_and_needs_no_python(plan, name):
    text = plan(name)
    assert "Exchange" not in text
    assert "Python" not in text and "Arrow" not in text


def test_values_of_a_tuple_are_found_once(plan):
    # The tuples of a line, and the values of a tuple.
    assert plan("sql_tuple_parse").count("regexp_extract_all") == 2
    assert plan("props_flatten").count("from_json") <= 1


def test_first_touch_shuffles_touches_only(plan):
    text = plan("first_touch")
    assert text.count("Exchange") == 1
    others, touches = text.split("Exchange")
    assert "(event_type" in others and "click" in touches


def test_day_numbers_are_joined_without_a_shuffle_of_the_events(plan):
    text = plan("message_events_unified")
    assert "BroadcastHashJoin [landing_day" in text
    assert "hashpartitioning(landing_day" not in text


def test_replies_are_shuffled_once(plan):
    text = plan("reply_to_sent_in_buckets")
    wide = [e for e in text.split("Exchange")[1:] if "_reply#" in e.split("+- Sort")[0]]
    assert "SortMergeJoin" in text and len(wide) <= 1


@pytest.mark.parametrize("name", ["dedup_key", "latest_per_key", "last_turn", "recipient_rows"])
def test_no_cross_joins(plan, name):
    text = plan(name)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_the_channel_summary_makes_no_ids_and_no_texts(plan):
    text = plan("channel_summary")
    assert "sha2(" not in text and "to_json" not in text and "regexp_replace" not in text
    read = {c.split(":")[0] for s in re.findall(r"ReadSchema: struct<(.*?)>", text) for c in s.split(",")}
    assert read == {"o_orderkey", "o_orderdate"}
