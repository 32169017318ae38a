"""Readers, writers and whole jobs on files."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import uuid
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom import session
from msgloom.config import EventSettings, Lineage
from msgloom.operators import aggregate
from msgloom.operators import rows as rows_of_pages
from msgloom.plans import dumps, events, landing, leads, notifications, pages, replies
from msgloom.schemas import LEAD, MESSAGE_EVENT, NOTIFICATION, UNIFIED, WEBHOOK
from msgloom.sinks import writers
from msgloom.sources import dump_text, readers
from msgloom.streaming import streams

WHEN = dt.datetime(2025, 12, 1, 6)
LINEAGE = Lineage("src", "46", user_id="85")


def values(df, *columns):
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=str)


def put(path, *documents, indent=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(d, indent=indent) for d in documents))


# --- sources -----------------------------------------------------------------------
def test_envelopes_and_flat_files_side_by_side(spark, tmp_path):
    """A flat schema would give one null row per envelope, an envelope schema none per flat file."""
    meta = {"batch_number": 1, "record_count": 2, "ingestion_timestamp": "t", "source": "api"}
    records = [
        {"id": "a", "data": {"k": "v"}, "contents": {"en": "x"}, "unknown": 1},
        {"id": "b", "successful": 3, "platform_delivery_stats": {"ios": {"failed": 2}}},
    ]
    put(tmp_path / "year=2025/a.json", {"metadata": meta, "data": records}, indent=2)
    put(tmp_path / "year=2025/b.json", {"metadata": meta, "data": []}, indent=2)
    put(tmp_path / "c.json", {"id": "c", "data": {"k": "w"}, "isSMS": True}, indent=2)
    got = readers.read_notifications(spark, str(tmp_path), NOTIFICATION)
    assert got.schema.simpleString() == NOTIFICATION.simpleString()
    rows = {r.id: r for r in got.collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].data == {"k": "v"} and rows["a"].contents == {"en": "x"}
    assert rows["b"].platform_delivery_stats["ios"].failed == 2
    assert rows["c"].data == {"k": "w"} and rows["c"].isSMS
    documents = readers.read_envelopes(spark, str(tmp_path / "year=2025"), NOTIFICATION)
    assert values(readers.unwrap_envelope(documents), "id", "landing_source") == [
        ("a", "api"), ("b", "api"),
    ]
    assert values(readers.envelope_mismatches(documents), "records_held") == [(0,)]


def test_files_that_are_no_records_are_kept_apart(spark, tmp_path):
    meta = {"batch_number": 1, "record_count": 1, "ingestion_timestamp": "t", "source": "api"}
    put(tmp_path / "in/good.json", {"metadata": meta, "data": [{"id": "a"}]})
    put(tmp_path / "in/flat.json", {"id": "b", "data": {"k": "v"}})
    put(tmp_path / "in/none.json", {"metadata": meta, "data": []})
    (tmp_path / "in/torn.json").write_text('{"id": "c", "name"')
    put(tmp_path / "in/odd.json", {"metadata": meta, "data": "no list"})
    good, bad = readers.read_checked_notifications(spark, str(tmp_path / "in"), NOTIFICATION)
    assert values(good, "id") == [("a",), ("b",)]
    found = {(r.file.rsplit("/", 1)[1], r.reason) for r in bad.collect()}
    assert found == {("torn.json", "Invalid JSON"), ("odd.json", "Invalid data")}


def test_torn_lines_of_events_are_counted(spark, tmp_path):
    layers = layers_at(tmp_path)
    land(tmp_path, 1, event("a", SENT, 1))
    with (tmp_path / "landing/year=2025/month=11/day=01/x.json").open("a") as file:
        file.write('\n{"type": "event", "id"\n')
    found = events.run(spark, layers, dt.date(2025, 11, 1), dt.date(2025, 11, 1), LINEAGE, WHEN)
    assert (found["landing_rows"], found["corrupt_lines"], found["unified_rows"]) == (2, 1, 1)


def test_files_of_runs_long_done_are_not_read(spark, tmp_path):
    put(tmp_path / "old.json", {"id": "old"})
    put(tmp_path / "new.json", {"id": "new"})
    os.utime(tmp_path / "old.json", (1_600_000_000, 1_600_000_000))
    every = readers.read_notifications(spark, str(tmp_path), NOTIFICATION)
    late = readers.read_notifications(spark, str(tmp_path), NOTIFICATION, "2021-01-01T00:00:00")
    assert values(every, "id") == [("new",), ("old",)] and values(late, "id") == [("new",)]


def test_payload_of_text_or_struct(spark):
    kind = T.StructType().add("x", "integer")
    df = spark.createDataFrame(
        [(1, '{"x": 5, "y": 1}'), (2, "{"), (3, None), (4, '{"x": "no"}')], "id INT, body STRING"
    )
    good, bad = readers.parse_payload(df, "body", kind)
    assert values(good) == [(1, 5)]
    assert values(bad, "id", "error") == [(i, "Invalid JSON") for i in (2, 3, 4)]
    nested = spark.createDataFrame([(1, (5,))], "id INT, body STRUCT<x: INT>")
    good, bad = readers.parse_payload(nested, "body", kind)
    assert values(good) == [(1, 5)] and bad.count() == 0


def test_layer_of_the_day_or_the_day_before(spark, tmp_path):
    path = str(tmp_path / "layer")
    df = spark.createDataFrame([(1, "20251130"), (2, "20251115")], "n INT, processing_date STRING")
    writers.append_layer(df, path)
    assert values(readers.read_layer_or_previous(spark, path, WHEN), "n") == [(1,)]
    writers.append_layer(df.filter("n = 1").withColumn("processing_date", F.lit("20251201")), path)
    got = readers.read_layer_or_previous(spark, path, WHEN, df.schema)
    assert values(got) == [(1, "20251201")]
    with pytest.raises(ValueError, match="no rows"):
        readers.read_layer_or_previous(spark, path, dt.datetime(2026, 3, 1))


def test_day_window_is_half_open(spark):
    times = [dt.datetime(2025, 12, 1), dt.datetime(2025, 12, 1, 23, 59, 59, 999999),
             dt.datetime(2025, 12, 2), dt.datetime(2025, 11, 30, 23)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "n INT, t TIMESTAMP")
    assert values(readers.half_open_day_window(df, "t", "2025-12-01"), "n") == [(0,), (1,)]
    got = landing.day_window_records(df, "t", "2025-12-01", "n")
    assert [r.n for r in got.collect()] == [0, 1]


def test_day_range_opens_no_other_folder(spark, tmp_path):
    df = spark.range(1, 11).select(
        "id", F.lit(2025).alias("year"), F.lit("11").alias("month"),
        F.lpad(F.col("id").cast("string"), 2, "0").alias("day"),
    )
    path = str(tmp_path / "days")
    writers.write_ndjson(df, path, 10, ["year", "month", "day"])
    kind = T.StructType().add("id", "long")
    got = readers.read_day_range(
        readers.read_ndjson(spark, path, kind, by_day=True), "2025-11-03", "2025-11-05"
    )
    assert values(got, "id", "day") == [(3, "03"), (4, "04"), (5, "05")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(got.select("_metadata.file_path").distinct().collect()) == 3


# --- sinks -------------------------------------------------------------------------
def test_csv_keeps_commas_quotes_and_line_breaks(spark, tmp_path):
    rows = [("a,b", 'say "x"'), ("it's", "two\nlines")]
    path = str(tmp_path / "csv")
    writers.write_csv(spark.createDataFrame(rows, "a STRING, b STRING"), path)
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(path)
    assert values(back) == sorted(rows, key=str)


def test_ndjson_files_are_capped(spark, tmp_path):
    path = str(tmp_path / "capped")
    writers.write_ndjson(spark.range(0, 25, 1, 1), path, 10)
    sizes = spark.read.text(path).groupBy("_metadata.file_path").count()
    assert sorted(r["count"] for r in sizes.collect()) == [5, 10, 10]


def test_overwrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n INT, day STRING")
    for _ in range(2):
        writers.overwrite_partitions(writers.compact(df, "day"), path, ["day"])
    writers.overwrite_partitions(spark.createDataFrame([(9, "b")], df.schema), path, ["day"])
    assert values(readers.read_layer(spark, path, df.schema)) == [(1, "a"), (9, "b")]


def test_guard_writes_nothing_for_no_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not writers.guard_empty(spark.range(0), lambda df: writers.append_unified(df, path))
    assert not (tmp_path / "none").exists()
    assert writers.guard_empty(spark.range(1), lambda df: writers.append_unified(df, path))


def test_envelopes_hold_every_record_once(spark, tmp_path):
    records = spark.range(0, 997, 1, 5).select(F.col("id").cast("string").alias("id"))
    documents = landing.envelopes(records, 50, "api", WHEN, ["id"])
    path = str(tmp_path / "docs")
    landing.write_envelopes(documents, path)
    back = readers.read_envelopes(spark, path, records.schema)
    assert back.agg(F.max(F.size("data"))).first()[0] <= 50
    assert readers.envelope_mismatches(back).count() == 0
    assert values(readers.unwrap_envelope(back), "id") == values(records)


def test_envelope_files_are_compressed(spark, tmp_path):
    """The blanks and names of pretty-printed documents were most of what was written."""
    records = spark.range(0, 500, 1, 2).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("name"))
    path = str(tmp_path / "docs")
    landing.write_envelopes(landing.envelopes(records, 100, "api", WHEN, ["id"]), path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 5 and all(f.endswith(".gz") for f in files)
    texts = spark.read.text(path, wholetext=True).agg(F.sum(F.length("value"))).first()[0]
    assert 4 * sum(os.path.getsize(f"{path}/{f}") for f in files) < texts
    assert values(readers.read_notifications(spark, path, NOTIFICATION), "id") == values(records, "id")


def test_bad_files_are_counted_while_records_are_read(spark, tmp_path):
    meta = {"batch_number": 1, "record_count": 1, "ingestion_timestamp": "t", "source": "api"}
    put(tmp_path / "good.json", {"metadata": meta, "data": [{"id": "a"}, {"id": "b", "failed": "many"}]})
    put(tmp_path / "null.json", {"metadata": meta, "data": [{"id": "c"}, None]})
    put(tmp_path / "flat.json", {"id": "d", "name": '"metadata"', "data": {"k": "v"}})
    put(tmp_path / "odd.json", {"metadata": meta, "data": "no list"})
    (tmp_path / "torn.json").write_text('{"metadata": ')
    seen = Observation("bad-files")
    good, bad = readers.read_checked_notifications(spark, str(tmp_path), NOTIFICATION, seen=seen)
    ids = [r[0] for r in good.select("id").collect()]
    assert sorted(ids, key=str) == [None, "a", "b", "c", "d"] or sorted(ids, key=str) == ["a", "b", "c", "d"]
    assert aggregate.observed(seen)["bad"] == bad.count() == 2


def test_known_versions_are_looked_up_by_id_alone(spark, tmp_path):
    put(tmp_path / "in/a.json", {"id": "a"})
    landed, _ = readers.read_checked_notifications(spark, str(tmp_path / "in"), NOTIFICATION)
    raw = notifications.to_raw(landed, LINEAGE, WHEN, 1, "in")
    layers = notifications.Layers(*[str(tmp_path / n) for n in ("in", "raw", "opt", "table", "log")])
    none = notifications._not_known(spark, raw, raw, layers, str(tmp_path / "w1"))
    assert none.count() == 0 and "Join" not in none._jdf.queryExecution().optimizedPlan().toString()
    new = notifications._not_known(spark, raw, raw.filter("id = 'b'"), layers, str(tmp_path / "w2"))
    assert values(new, "id") == [("a",)]
    assert "BroadcastHashJoin" in new._jdf.queryExecution().executedPlan().toString()


def test_joined_records_come_in_large_batches():
    """One batch for each record of several lines made the second reading slow."""
    lines = ["(1,'a", "b'),", "(2,'c'),"] * 1000
    moves = [{"(1,'a": 9 * 2 + 1, "b'),": 9 * 2 + 1}.get(line, dump_text.STAY) for line in lines]
    batch = pa.RecordBatch.from_pydict(
        {"value": lines, "file": ["f"] * 3000, "block": [0] * 3000, "move": pa.array(moves, pa.int32()),
         "starts_in": pa.array([0] * 3000, pa.int32())}
    )
    out = list(dump_text._records(iter([batch])))
    assert len(out) <= 2
    assert [v for b in out for v in b.column(0).to_pylist()] == ["(1,'a\nb'),", "(2,'c'),"] * 1000


def test_backfill_shuffles_no_columns_that_it_adds(spark, tmp_path):
    landed = spark.createDataFrame([], MESSAGE_EVENT).withColumns(
        {"year": F.lit(2025), "month": F.lit("12"), "day": F.lit("01")}
    )
    optimized = events.to_optimized(events.to_raw(landed, LINEAGE, WHEN), WHEN, gather=events.DAY)
    plan = optimized.select("optimized_id", "source_event_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS optimized_id") < plan.index("RebalancePartitions")
    path = str(tmp_path / "layer")
    writers.overwrite_partitions(spark.range(3).withColumn("d", F.lit(1)), path, ["d"])
    assert all(".zstd." in f for f in os.listdir(f"{path}/d=1") if f.startswith("part-"))
    writers.write_ndjson(spark.range(25), str(tmp_path / "lines"), 10, compression="gzip")
    assert all(f.endswith(".gz") for f in os.listdir(tmp_path / "lines") if f.startswith("part-"))


class FakeSession:
    """The two settings the folder depends on."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = SimpleNamespace(master=master)


def test_shared_dir_takes_the_session_setting():
    cluster = FakeSession("s3://shared/work/", "yarn")
    assert session.shared_dir(cluster, "x").startswith("s3://shared/work/msgloom/x-")
    assert session.shared_dir(cluster, "x") != session.shared_dir(cluster, "x")
    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(FakeSession(None, "yarn"), "x")
    assert "/msgloom/x-" in session.shared_dir(FakeSession(None, "local[8]"), "x")


# --- message events ----------------------------------------------------------------
CLICK, SENT, RECEIVED = "Uv32rW", "XsRJQh", "SGB8Vt"


def event(i, code, day, second=0, profile="p", message="m", bot=None, stamp=None):
    base = int(dt.datetime(2025, 11, day, tzinfo=dt.timezone.utc).timestamp())
    properties = {"$message": message, "Bot Click": bot, "Message Name": "N", "Credits": 2,
                  "To Number": "+1", "From Number": "+2",
                  "$extra": {"Message Body": "B", "IP Address": "1.1.1.1"}}
    return {
        "type": "event",
        "id": i,
        "attributes": {
            "timestamp": base + second,
            "datetime": stamp or f"2025-11-{day:02d}T00:00:{second:02d}+00:00",
            "profile_id": profile,
            "event_properties": {k: v for k, v in properties.items() if v is not None},
        },
        "relationships": {"metric": {"data": {"id": code}}, "profile": {"data": {}}},
    }


def land(base, day, *found):
    put(base / f"landing/year=2025/month=11/day={day:02d}/x.json", *found)


def layers_at(base):
    return events.Layers(*[str(base / n) for n in ("landing", "raw", "opt", "unified", "log")])


def unified_rows(spark, layers):
    day = F.col("landing_day").cast("string")
    return values(readers.read_layer(spark, layers.unified).withColumn("landing_day", day),
                  "source_id", "status", "batch_id", "landing_day", "event_date")


@pytest.fixture
def landed(tmp_path):
    land(tmp_path, 1,
         event("a", CLICK, 1, 5), event("a", CLICK, 1, 5),    # landed twice
         event("b", CLICK, 1, 5), event("c", CLICK, 1, 3, bot=True),
         event("d", CLICK, 1, 9, profile=None), event("e", CLICK, 1, 8, profile=None),
         event("s", SENT, 1), event("x", "other", 1))
    land(tmp_path, 2, event("x", "other", 2))  # a day whose rows are all filtered out
    # Day 3 is missing; day 4 has a click again and an event dated the day before.
    land(tmp_path, 4, event("f", CLICK, 4), event("r", RECEIVED, 4, stamp="2025-11-01T23:59:59Z"))
    return tmp_path


EXPECTED = [
    ("a", "SMS CLICKED", 1, "2025-11-01", dt.date(2025, 11, 1)),
    ("e", "SMS CLICKED", 1, "2025-11-01", dt.date(2025, 11, 1)),
    ("f", "SMS CLICKED", 3, "2025-11-04", dt.date(2025, 11, 4)),
    ("r", "SMS DELIVERED", 3, "2025-11-04", dt.date(2025, 11, 1)),
    ("s", "SMS SEND", 1, "2025-11-01", dt.date(2025, 11, 1)),
]


def test_backfill_and_its_repetition(spark, landed):
    layers = layers_at(landed)
    for _ in range(2):
        found = events.run(
            spark, layers, dt.date(2025, 11, 1), dt.date(2025, 11, 30), LINEAGE, WHEN
        )
        assert found == {"landing_rows": 11, "corrupt_lines": 0, "optimized_rows": 5,
                         "unified_rows": 5}
        assert unified_rows(spark, layers) == EXPECTED
    log = spark.read.parquet(layers.run_log)
    assert values(log, "status", "total_records") == [("completed", 11)] * 2


def test_one_day_again_leaves_rows_dated_into_it_by_another_day(spark, landed):
    layers = layers_at(landed)
    events.run(spark, layers, dt.date(2025, 11, 1), dt.date(2025, 11, 30), LINEAGE, WHEN)
    events.run(spark, layers, dt.date(2025, 11, 1), dt.date(2025, 11, 1), LINEAGE, WHEN)
    assert unified_rows(spark, layers) == EXPECTED


def test_days_loaded_again_are_replaced_and_days_gone_are_left(spark, landed):
    layers = layers_at(landed)
    whole = dt.date(2025, 11, 1), dt.date(2025, 11, 30)
    events.run(spark, layers, *whole, LINEAGE, WHEN)
    land(landed, 1, event("x", "other", 1))  # no known event any more
    (landed / "landing/year=2025/month=11/day=04/x.json").unlink()
    (landed / "landing/year=2025/month=11/day=04").rmdir()
    events.run(spark, layers, *whole, LINEAGE, WHEN)
    assert unified_rows(spark, layers) == [r for r in EXPECTED if r[3] == "2025-11-04"]
    for layer in (layers.raw, layers.optimized):
        assert values(readers.read_layer(spark, layer).select("day").distinct()) == [(4,)]


def test_range_at_once_is_day_by_day(spark, landed):
    at_once, by_day = layers_at(landed), layers_at(landed / "other")
    by_day = events.Layers(at_once.landing, *[getattr(by_day, n) for n in
                                              ("raw", "optimized", "unified", "run_log")])
    events.run(spark, at_once, dt.date(2025, 11, 1), dt.date(2025, 11, 4), LINEAGE, WHEN)
    for day in range(1, 5):
        events.run(spark, by_day, dt.date(2025, 11, day), dt.date(2025, 11, day), LINEAGE, WHEN)
    columns = [c for c in UNIFIED.fieldNames() if c != "batch_id"]
    assert values(readers.read_layer(spark, at_once.unified), *columns) == values(
        readers.read_layer(spark, by_day.unified), *columns
    )


def test_unmapped_and_kept_columns_are_all_columns(spark, landed):
    df = readers.read_ndjson(spark, layers_at(landed).landing, MESSAGE_EVENT, by_day=True)
    batches = aggregate.run_batch_counter(df, list(events.DAY))
    optimized = events.to_optimized(events.to_raw(df, LINEAGE, WHEN), WHEN)
    row = events.to_unified(optimized, batches, WHEN).filter("source_id = 's'").first()
    packed = json.loads(row.unmapped)
    assert list(packed)[:2] == ["record_type", "unix_timestamp"]
    assert packed["direction"] == "MO" and packed["cost_usd"] == pytest.approx(0.18)
    assert not set(packed) & set(UNIFIED.fieldNames())
    assert row.utm_content == "N" and row.phone == "+2" and row.connector_id == 46


def test_first_touch_over_the_whole_range(spark, landed):
    settings = EventSettings(day_columns=())
    df = readers.read_ndjson(spark, layers_at(landed).landing, MESSAGE_EVENT, by_day=True)
    raw = events.to_raw(df, LINEAGE, WHEN, settings)
    clicks = events.to_optimized(raw, WHEN, settings).filter("event_name = 'SMS Clicked'")
    assert values(clicks, "source_event_id") == [("a",), ("e",)]


def test_failed_run_is_logged_and_raised(spark, tmp_path):
    layers = layers_at(tmp_path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        events.run(spark, layers, dt.date(2025, 11, 1), dt.date(2025, 11, 2), LINEAGE, WHEN)
    assert values(spark.read.parquet(layers.run_log), "status") == [("failed",)]


# --- notifications -----------------------------------------------------------------
@pytest.mark.parametrize("filters", [None, "known-ids"])
def test_notification_job_over_three_runs(spark, tmp_path, filters):
    name = f"t_{uuid.uuid4().hex[:8]}"
    layers = notifications.Layers(
        *[str(tmp_path / n) for n in ("landing", "raw", "opt")], name,
        str(tmp_path / "log"), str(tmp_path / "table"), known_ids=filters and str(tmp_path / filters),
    )
    first = {"id": "a", "successful": 8, "failed": 1, "errored": 1, "converted": 2,
             "queued_at": 1764547200, "isEmail": True, "contents": {"en": "Hi {{n}} http://x"}}
    put(tmp_path / "landing/1.json", first, indent=1)
    put(tmp_path / "landing/2.json", {"id": "z"}, indent=1)
    found = notifications.run(spark, layers, LINEAGE, WHEN)
    assert (found["raw_rows"], found["raw_email"], found["unified_rows"]) == (2, 1, 2)
    origin = readers.read_layer(spark, layers.raw).select("id", "data_source_path").collect()
    assert {r.id: r.data_source_path.rsplit("/", 1)[1] for r in origin} == {"a": "1.json", "z": "2.json"}
    row = readers.read_layer(spark, layers.optimized).filter("campaign_id = 'a'").first()
    assert (row.sends, row.success_rate, row.click_through_rate) == (10, 80.0, 25.0)
    assert (row.has_links, row.links_shortened, row.content_text_clean) == (1, None, "Hi  http://x")
    assert row.audience_segments == "ALL_USERS" and row.delivery_status == "IN_PROGRESS"

    # All landing files are read again: nothing comes twice.
    found = notifications.run(spark, layers, LINEAGE, WHEN)
    assert found.get("raw_rows", 0) == 0 and found["unified_rows"] == 0
    assert spark.table(name).count() == 2

    # Another version of a notification arrives; raw keeps both, the campaign shows the newer,
    # and the table holds it once.
    put(tmp_path / "landing/3.json", {**first, "successful": 9, "completed_at": 1764550000})
    later = WHEN + dt.timedelta(hours=1)
    assert notifications.run(spark, layers, LINEAGE, later)["raw_rows"] == 1
    row = readers.read_layer(spark, layers.optimized).filter("campaign_id = 'a'").first()
    assert (row.delivered, row.delivery_status, row.batch_id) == (9, "COMPLETED", 2)
    unified = spark.table(name)
    assert sorted(unified.columns) == sorted(UNIFIED.fieldNames())
    got = unified.filter("campaign_id = 'a'").select("event_type", "event_date", "batch_id")
    day = dt.date(2025, 12, 1)
    assert values(got) == [("EMAIL", day, 2)]
    zero = readers.read_layer(spark, layers.optimized).filter("campaign_id = 'z'").first()
    assert (zero.sends, zero.success_rate, zero.campaign_name) == (0, 0.0, "Unknown Campaign")

    # A change in any field is a version: canceled, and another day on which it was queued.
    moved = {**first, "successful": 9, "completed_at": 1764550000, "queued_at": 1764650000}
    put(tmp_path / "landing/4.json", {**moved, "canceled": True})
    last = WHEN + dt.timedelta(hours=2)
    assert notifications.run(spark, layers, LINEAGE, last)["raw_rows"] == 1
    got = spark.table(name).filter("campaign_id = 'a'").collect()
    assert [json.loads(r.unmapped)["delivery_status"] for r in got] == ["CANCELED"]
    assert [r.event_date for r in got] == [dt.date(2025, 12, 2)] and spark.table(name).count() == 2


def test_days_of_a_failed_notification_run_are_taken_up_later(spark, tmp_path, monkeypatch):
    name = f"t_{uuid.uuid4().hex[:8]}"
    layers = notifications.Layers(
        *[str(tmp_path / n) for n in ("landing", "raw", "opt")], name,
        str(tmp_path / "log"), str(tmp_path / "table"),
    )
    put(tmp_path / "landing/1.json", {"id": "a", "queued_at": 1764547200})
    with monkeypatch.context() as patch:
        patch.setattr(notifications, "to_optimized", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            notifications.run(spark, layers, LINEAGE, WHEN)
    put(tmp_path / "landing/2.json", {"id": "b", "queued_at": 1764547200})
    found = notifications.run(spark, layers, LINEAGE, WHEN + dt.timedelta(days=1))
    assert (found["raw_rows"], found["optimized_rows"], found["unified_rows"]) == (1, 2, 2)
    put(tmp_path / "landing/3.json", {"id": "c", "queued_at": 1764547200})
    with monkeypatch.context() as patch:
        patch.setattr(notifications, "to_unified", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            notifications.run(spark, layers, LINEAGE, WHEN + dt.timedelta(days=1))
    notifications.run(spark, layers, LINEAGE, WHEN + dt.timedelta(days=2))
    assert values(spark.table(name), "campaign_id") == [("a",), ("b",), ("c",)]
    log = spark.read.parquet(layers.run_log)
    assert sorted(r.status for r in log.collect()) == ["completed"] * 2 + ["failed"] * 2


# --- landing -----------------------------------------------------------------------
def test_landing_goes_on_from_its_position(spark, tmp_path):
    data, log = str(tmp_path / "data"), str(tmp_path / "log")
    kind = "id INT, t TIMESTAMP"
    rows = [(i, dt.datetime(2025, 1, 1 + i)) for i in range(5)]

    def run(found, hour):
        when = WHEN + dt.timedelta(hours=hour)
        return landing.run(spark, spark.createDataFrame(found, kind), "t", data, log, when)

    assert run(rows[:3], 0)["records"] == 3
    assert run(rows[:3], 1) == {"records": 0, "start_cursor": "2025-01-03 00:00:00.000000",
                                "end_cursor": "2025-01-03 00:00:00.000000"}
    assert run(rows, 2)["records"] == 2
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        broken = spark.createDataFrame(rows, kind).withColumn("id", F.expr("1 / (id - id)"))
        landing.run(spark, broken.withColumn("t", F.expr("t + interval 9 day")), "t", data, log, WHEN)
    assert landing.last_cursor(spark, log, "landing") == "2025-01-05 00:00:00.000000"
    back = spark.read.schema("id INT").json(data)
    assert values(back.filter("id IS NOT NULL"), "id") == [(i,) for i in range(5)]


def test_late_rows_land_by_their_key(spark, tmp_path):
    data, log = str(tmp_path / "data"), str(tmp_path / "log")
    at = [dt.datetime(2025, 1, 1 + i) for i in range(5)]

    def run(found, hour):
        df = spark.createDataFrame(found, "id INT, t TIMESTAMP")
        when = WHEN + dt.timedelta(hours=hour)
        return landing.run(spark, df, "t", data, log, when, key="id", overlap=dt.timedelta(days=2))

    rows = [(0, at[0]), (1, at[2]), (2, at[3]), (3, None)]
    assert run(rows, 0)["records"] == 4
    late = [(4, at[3]), (5, at[1]), (6, None), (7, dt.datetime(2020, 1, 1))]
    assert run(rows + late, 1)["records"] == 3  # all but the one before the overlap
    assert run(rows + late, 2)["records"] == 0
    assert run([(8, at[4])], 3)["end_cursor"].startswith("2025-01-05")
    back = spark.read.schema("id INT").json(data)
    assert values(back.filter("id IS NOT NULL"), "id") == [(i,) for i in (0, 1, 2, 3, 4, 5, 6, 8)]
    plain = spark.createDataFrame(rows, "id INT, t TIMESTAMP")
    landing.run(spark, plain, "t", str(tmp_path / "d2"), str(tmp_path / "l2"), WHEN)
    assert spark.read.parquet(str(tmp_path / "l2")).first().metrics == {"records": 3, "without_time": 1}


# --- dumps, leads, replies, pages --------------------------------------------------
def test_dump_job(spark, tmp_path):
    source = tmp_path / "dump.sql"
    source.write_text("INSERT INTO t\n(`a`,`b`),\n\n (1,'x, y'),\n(2,NULL);\n(3),\n")
    paths = [str(tmp_path / n) for n in ("csv", "bad", "log")]
    assert dumps.clean_dump(spark, str(source), *paths, WHEN) == {"rows": 2, "rejected": 1}
    text = [r.value for r in spark.read.text(paths[0]).collect()]
    assert [t for t in text if t != "a,b"] == ['1,"x, y"', "2,"]
    (tmp_path / "none.sql").write_text("(1,2),\n")
    with pytest.raises(ValueError, match="no header"):
        dumps.clean_dump(spark, str(tmp_path / "none.sql"), *paths, WHEN)


def test_mixed_job(spark, tmp_path):
    (tmp_path / "mixed").write_text("a,b\n ('1','it''s',NULL),\n\n(2,'x');\n(3,4)\n")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    found = dumps.clean_mixed(spark, str(tmp_path / "mixed"), out, log, WHEN)
    assert found == {"lines_processed": 4, "lines_cleaned": 2}
    assert values(spark.read.text(out)) == [("(3,4)",), ("1,its,NULL",), ("2,x",), ("a,b",)]


def lead(**given):
    base = {"name": "Bo", "phone": "(555) 010-0001", "agent_name": "Ann Lee",
            "agent_phone": "15550100002", "address_line_1": "1 Road", "zip_code": "98",
            "beds": "3", "baths": "2", "is_flexible": "true",
            "availability": {"saturday_midday": True, "sunday_evening": "true"}}
    return json.dumps({**base, **given})


def test_leads_job(spark, tmp_path):
    bodies = [
        lead(), lead(name=None, use_first_selection_logic=False), lead(phone="abc"),
        lead(address_line_1=""), lead(address_line_1=None, use_first_selection_logic=False),
        lead(zip_code=None), "{",
    ]
    good, bad = readers.parse_payload(
        spark.createDataFrame([(b,) for b in bodies], "body STRING"), "body", LEAD
    )
    assert bad.count() == 1
    rendered, invalid = leads.render(leads.lead_normalise(good))
    assert values(invalid, "reason") == [
        ("Missing required fields: address_line",), ("Missing required fields: consumer_phone",),
    ]
    texts = [r.three_way_text for r in rendered.collect()]
    assert sum("Saturday - Midday" in t for t in texts) == 2
    assert sum("Saturday mid-days (10am-2pm) or Sunday evenings" in t for t in texts) == 2
    assert values(rendered.filter("agent_text IS NULL"), "agent_missing") == [
        (["address_line"],), (["consumer_name"],), (["zip_code"],),
    ]
    paths = [str(tmp_path / n) for n in ("sent", "rejected", "log")]
    for _ in range(2):
        found = leads.run(spark, good, *paths, "+15550199", WHEN)
        assert found == {"sent_rows": 8, "rejected_rows": 2}
    sent = readers.read_layer(spark, paths[0])
    assert sent.count() == 8
    twice = leads.sent_log(leads.render(leads.lead_normalise(good.unionByName(good)))[0], "+1", WHEN)
    assert twice.count() == 16 and twice.select("message_sid").distinct().count() == 8
    again = leads.sent_log(rendered, "+1", WHEN + dt.timedelta(days=90))
    assert not set(values(again, "message_sid")) & set(values(sent, "message_sid"))
    assert {r.recipient_number for r in sent.collect()} == {"+15550100001", "+15550100002"}
    assert "+" not in sent.first().log_key
    current = leads.current_conversations(sent)
    assert current.count() == 2


def test_replies(spark, tmp_path):
    put(tmp_path / "in/a.json",
        {"headers": {"cf-ipcountry": "US"}, "body": {"Body": "Yes", "From": "+1", "To": "+2",
         "SmsMessageSid": "S1", "NumMedia": "0", "ToState": "WA"}},
        {"headers": {}, "body": {"Body": "No", "Author": "+1", "MessageSid": "I1",
         "ConversationSid": "C1", "DateCreated": "2025-11-02T03:04:05.000Z"}})
    requests = readers.read_webhook_payloads(spark, str(tmp_path / "in"))
    sms = replies.reply_projection_sms(requests, WHEN)
    assert len(sms.columns) == 12
    assert values(sms, "message_sid", "recipient_country", "recipient_state") == sorted(
        [("S1", "US", "WA"), (None, None, None)], key=str
    )
    talk = replies.reply_projection_conversation(requests, WHEN)
    assert len(talk.columns) == 24
    row = talk.filter("conversation_sid = 'C1'").first()
    assert (row.year, row.month, row.day, row.direction) == ("2025", "11", "02", "inbound")
    assert row.customer_name == "" and row.sender_country is None
    for _ in range(2):
        replies.intake(requests, str(tmp_path / "sms"), str(tmp_path / "talk"), WHEN, "r1")
    assert (tmp_path / "sms/run=r1/year=2025/month=12/day=01").is_dir()
    assert (tmp_path / "talk/run=r1/year=2025/month=11/day=02").is_dir()
    assert spark.read.json(str(tmp_path / "sms")).count() == 2
    replies.intake(requests.limit(1), str(tmp_path / "sms"), str(tmp_path / "talk"), WHEN, "r2")
    assert spark.read.json(str(tmp_path / "sms")).count() == 3


def test_cells_of_tables_within_tables(spark):
    inner = "<table><tr><td>x</td><td>y</td></tr></table>"
    page = f"<table><TR><td>a</td><td>{inner}{inner}</td><td>b</td></TR><tr><td>c</td></tr></table>"
    df = spark.createDataFrame([(1, page + page)], "page_id BIGINT, html STRING")
    found = rows_of_pages.extract_html_rows(df)
    assert [r.cells for r in found.orderBy("row_number").collect()] == [["a", "xyxy", "b"], ["c"]] * 2


def test_page_rows(spark, tmp_path):
    def row(n):
        return "<tr class='a singleLineDisplay DisplayRegRow'>" + "".join(f"<td>{n}.{i}</td>" for i in range(n)) + "</tr>"

    heading = "<tr class='DisplayRegRow singleLineDisplay'>" + "<th>H</th>" * 12 + "</tr>"
    other = "<tr>" + "<td>o</td>" * 12 + "</tr>"
    page = "<table>" + heading + row(9) + other + row(5) + row(12) + "</table>"
    df = spark.createDataFrame([(1, page)], "page_id BIGINT, html STRING")
    roster = pages.roster_rows(df)
    assert values(roster, "Last Name", "Email") == [("12.2", "12.8"), ("9.2", "9.8")]
    listing = pages.listing_rows(df)
    assert values(listing, "MLS ID", "Address", "City", "Price") == [
        ("12.3", "12.6", "12.8", "12.10"), ("5.3", "N/A", "N/A", "N/A"), ("9.3", "9.6", "9.8", "N/A"),
    ]
    assert pages.write_rows(roster, str(tmp_path / "csv"))
    assert not pages.write_rows(roster.limit(0), str(tmp_path / "none"))


# --- streams -----------------------------------------------------------------------
TOUCH = "id STRING, who STRING, t TIMESTAMP"


def touch(i, who, second):
    return {"id": i, "who": who, "t": f"2025-11-01T00:00:{second:02d}Z"}


def test_stream_of_first_touches_takes_late_rows(spark, tmp_path):
    """An earlier row that comes in a later batch replaces the one kept so far."""
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        schema = spark.createDataFrame([], TOUCH).schema
        records = streams.read_files(spark, "json", str(tmp_path / "in"), schema)
        streams.stream_first_touch(records, ["who"], ["t", "id"], out, checkpoint)
        return values(streams.read_first_touch(spark, out, ["who"]), "who", "id")

    put(tmp_path / "in/1.json", touch("b", "x", 5), touch("c", "x", 7), touch("d", "y", 1))
    assert run() == [("x", "b"), ("y", "d")]
    put(tmp_path / "in/2.json", touch("a", "x", 2), touch("e", "y", 9), touch("b", "x", 5))
    assert run() == [("x", "a"), ("y", "d")]
    assert run() == [("x", "a"), ("y", "d")]


def test_stream_dedup_over_files_with_repeats(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    schema = spark.createDataFrame([], TOUCH).schema
    for n, found in enumerate(([("a", 1), ("b", 2), ("a", 1)], [("b", 2), ("c", 3)], [("a", 1)])):
        put(tmp_path / f"in/{n}.json", *[touch(i, "x", s) for i, s in found])
        records = streams.read_files(spark, "json", str(tmp_path / "in"), schema)
        once = streams.stream_dedup(records, "id", "t", "1 hour")
        streams.write_stream(once, out, checkpoint)
    assert values(spark.read.parquet(out), "id") == [("a",), ("b",), ("c",)]


def test_stream_dedup_of_one_id_in_most_rows(spark, tmp_path):
    """Copies of one id are spread by salt and still end as one row, over several batches."""
    copies = F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("id")
    when = F.timestamp_seconds(F.lit(1_761_955_200) + F.col("id") % 60).alias("t")
    files = spark.range(0, 3000, 1, 6).select(copies, when)
    files.write.parquet(str(tmp_path / "in"))
    records = streams.read_files(
        spark, "parquet", str(tmp_path / "in"), files.schema, maxFilesPerTrigger=2
    )
    for salts in (1, 4):
        out = str(tmp_path / f"out{salts}")
        once = streams.stream_dedup(records, "id", "t", "1 hour", salts)
        streams.write_stream(once, out, str(tmp_path / f"checkpoint{salts}"))
        got = spark.read.parquet(out)
        assert got.columns == ["id", "t"]
        assert values(got, "id") == values(files.select("id").distinct())


def test_two_outputs_of_a_repeated_batch_hold_each_row_once(spark, tmp_path):
    put(tmp_path / "in/1.json", {"headers": {}, "body": {"Body": "x", "SmsMessageSid": "S"}})
    targets = {str(tmp_path / "a"): lambda df: df.select("body.Body"),
               str(tmp_path / "b"): lambda df: df.select("body.SmsMessageSid")}
    for attempt in ("one", "two"):  # the second one starts over, as after a lost checkpoint
        requests = streams.read_files(spark, "json", str(tmp_path / "in"), WEBHOOK)
        streams.write_two(requests, targets, str(tmp_path / attempt))
    for target in targets:
        assert spark.read.parquet(target).count() == 1


def dump_of(seed):
    """Records of a dump whose quoted values hold anything, comments among them."""
    rnd = random.Random(seed)
    signs = ["a", "''", "\\'", "\n", "\\\n", "x y", "-- z", "/*", "*/", "\\\\", "\r\n", "(", ","]
    found = []
    for i in range(90):
        text = "".join(rnd.choices(signs, k=400 if i % 40 == 0 else rnd.choice([3, 8, 60])))
        kinds = [f"({i},'{text}',NULL),"] * 8 + ["-- it's a comment", "/* a comment's\n 'second line */;"]
        found.append(rnd.choice(kinds))
    return found


@pytest.mark.parametrize("size", ["61", "4096", "10000000"])
def test_dump_records_over_lines_and_blocks(spark, tmp_path, size):
    """Values of many lines, over many blocks of a few bytes, come out whole and once."""
    want = []
    for seed in range(3):
        records = dump_of(seed)
        (tmp_path / f"{seed}.sql").write_bytes(("\n".join(records) + "\n").encode())
        want += records
    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = dump_text.read_dump_records(spark, str(tmp_path))
        assert sorted(r.value for r in got.collect()) == sorted(want)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("size", ["40", "10000000"])
def test_dump_with_a_stray_quote(spark, tmp_path, size):
    """What follows a quote that is never closed is read line by line, and nothing is lost."""
    source = "(1,'a'),\n(2,'it's'),\n" + "".join(f"({i},'b{i}'),\n" for i in range(3, 30)) + "(30,'x\ny');\n"
    (tmp_path / "dump.sql").write_text(source)
    paths = [str(tmp_path / n) for n in ("csv", "bad", "log")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        metrics = dumps.clean_dump(spark, str(tmp_path / "dump.sql"), *paths, WHEN, ["n", "t"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows = {r.n for r in spark.read.csv(paths[0], header=True, multiLine=True).collect()}
    bad = {r.line for r in spark.read.csv(paths[1], header=True, multiLine=True).collect()}
    assert {str(i) for i in (1, *range(3, 30))} <= rows and "(2,'it's')," in bad
    assert metrics["rows"] + metrics["rejected"] >= 30


def test_dump_without_lines(spark, tmp_path):
    (tmp_path / "none.sql").write_text("")
    assert dump_text.read_dump_records(spark, str(tmp_path / "none.sql")).count() == 0
