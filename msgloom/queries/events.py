"""Queries on ``events`` and the message-event job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom import config
from msgloom.config import EventSettings, Lineage
from msgloom.functions import numbers, times
from msgloom.operators import aggregate, classify, dedup, rows, shape
from msgloom.plans import events as event_job
from msgloom.queries.registry import query
from msgloom.queries.sql import (
    EVENT_CTES,
    EVENT_UNIFIED,
    case_sql,
    id_sql,
    listed,
    tables_with_k,
    unified_sql,
)
from msgloom.queries.tables import AS_OF, message_events, table, text, utc, with_k
from msgloom.schemas import UNIFIED
from msgloom.session import shared_dir
from msgloom.sinks import writers
from msgloom.sources import readers

LINEAGE = Lineage(source="events", connector_id="12", user_id="7001")

# Names the given event types stand for.
TYPE_NAMES = {
    "signup": "SMS Sent",
    "error": "SMS Failed",
    "click": "SMS Clicked",
    "view": "SMS Received",
}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_k(_events(spark, sf_dir))


def _batches(documents: DataFrame) -> DataFrame:
    return aggregate.run_batch_counter(documents, ["year", "month", "day"])


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def filter_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = classify.filter_in(_events(spark, sf_dir), "event_type", ["click", "view"])
    return kept.select("event_id", "event_type")


_NAME = case_sql("event_type", TYPE_NAMES, "Unknown")


@query(f"""
SELECT event_id, {_NAME} AS event_name,
  {case_sql(_NAME, config.EVENT_STATUSES, "OTHER")} AS status,
  CASE WHEN {_NAME} IN {listed(config.INBOUND_EVENTS)} THEN 'MO' ELSE 'MT' END AS direction
FROM events
""")
def map_event_name_status_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = classify.map_codes(F.col("event_type"), TYPE_NAMES, config.UNKNOWN_EVENT)
    return _events(spark, sf_dir).select(
        "event_id",
        name.alias("event_name"),
        classify.map_status(name).alias("status"),
        classify.map_direction(name).alias("direction"),
    )


@query(f"""
WITH {tables_with_k()}
SELECT event_id, {case_sql(_NAME, config.EVENT_STATUSES, "OTHER")} AS status, value
FROM src WHERE event_type IN ('click', 'view')
""")
def status_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = classify.map_codes(F.col("event_type"), TYPE_NAMES, config.UNKNOWN_EVENT)
    mapped = _events(spark, sf_dir).withColumn("status", classify.map_status(name))
    kept = classify.status_allow_list(mapped, "status", ["SMS CLICKED", "SMS DELIVERED"])
    return kept.select("event_id", "status", "value")


@query(f"""
WITH {tables_with_k()} SELECT event_id, CAST(k AS BIGINT) AS k, 'k' || k AS k_text FROM src
WHERE event_id % 50 <> 0
""")
def props_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties to typed columns; every 50th body is cut short and goes to the error side."""
    good, _ = _parsed(spark, sf_dir)
    fields = {"event_id": ("event_id", "bigint"), "k": ("k", "bigint"),
              "k_text": (text("k", F.col("k")), "string")}
    return shape.flatten_nested(good, fields)


@query("SELECT event_id, 'Invalid JSON' AS error FROM events WHERE event_id % 50 = 0")
def payload_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir)[1].select("event_id", "error")


def _parsed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = _events(spark, sf_dir)
    cut = F.expr("left(props, length(props) - 1)")
    body = F.when(F.col("event_id") % 50 == 0, cut).otherwise(F.col("props"))
    return readers.parse_payload(
        events.select("event_id", body.alias("body")), "body", T.StructType.fromDDL("k INT")
    )


@query(f"""
WITH {tables_with_k()} SELECT event_id FROM src
WHERE event_type <> 'click' OR NOT coalesce(CASE WHEN k % 7 <> 0 THEN k % 5 = 0 END, FALSE)
""")
def bot_filter_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    flagged = _with_k(spark, sf_dir).withColumn("bot", F.when(k % 7 != 0, k % 5 == 0))
    return classify.drop_bots(flagged, "bot", F.col("event_type") == "click").select("event_id")


@query(f"""
WITH {tables_with_k()}
SELECT event_id, event_type, user_id, k FROM src WHERE event_type <> 'click'
UNION ALL
SELECT event_id, event_type, user_id, k FROM src WHERE event_type = 'click'
QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY ts, event_id) = 1
""")
def first_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    touched = dedup.first_touch(
        _with_k(spark, sf_dir), ["user_id", "k"], ["ts", "event_id"], F.col("event_type") == "click"
    )
    return touched.select("event_id", "event_type", "user_id", "k")


@query(f"""
WITH {tables_with_k()},
keyed AS (SELECT *, CASE WHEN k % 3 <> 0 THEN user_id END AS profile FROM src)
SELECT event_id, profile FROM keyed WHERE profile IS NULL
UNION ALL
SELECT event_id, profile FROM keyed WHERE profile IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY profile ORDER BY ts, event_id) = 1
""")
def first_touch_null_keys_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _with_k(spark, sf_dir).withColumn(
        "profile", F.when(F.col("k") % 3 != 0, F.col("user_id"))
    )
    touched = dedup.first_touch(
        keyed, ["profile"], ["ts", "event_id"], null_keys="keep", row_key="event_id"
    )
    return touched.select("event_id", "profile")


@query(f"""
WITH {tables_with_k()},
kept AS (
  SELECT * FROM src WHERE event_type <> 'click'
  UNION ALL
  SELECT * FROM (SELECT * FROM src WHERE event_type = 'click'
                 AND NOT coalesce(CASE WHEN k % 7 <> 0 THEN k % 5 = 0 END, FALSE))
  QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY ts, event_id) = 1)
SELECT {case_sql(_NAME, config.EVENT_STATUSES, "OTHER")} AS status,
  CAST(count(*) AS BIGINT) AS events,
  CAST(sum(CAST(value AS DECIMAL(38, 8))) AS DOUBLE) AS total_value
FROM kept GROUP BY 1
""")
def unique_touch_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: value by status, without bot clicks and with first clicks only."""
    k = F.col("k")
    is_click = F.col("event_type") == "click"
    flagged = _with_k(spark, sf_dir).withColumn("bot", F.when(k % 7 != 0, k % 5 == 0))
    human = classify.drop_bots(flagged, "bot", where=is_click)
    touched = dedup.first_touch(human, ["user_id", "k"], ["ts", "event_id"], where=is_click)
    name = classify.map_codes(F.col("event_type"), TYPE_NAMES, config.UNKNOWN_EVENT)
    return (
        touched.withColumn("status", classify.map_status(name))
        .groupBy("status")
        .agg(F.count("*").alias("events"), numbers.exact_sum(F.col("value")).alias("total_value"))
    )


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice, then each id once."""
    events = _events(spark, sf_dir)
    return dedup.dedup_by_key(rows.recombine(events, events), "event_id", [F.desc("ts")])


@query("SELECT event_id, value FROM events UNION ALL SELECT event_id, value FROM events")
def recombine(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return rows.recombine(events.select("event_id", "value"), events.select("value", "event_id"))


@query("SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def count_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.count_by(_events(spark, sf_dir), "event_type", "events")


@query("""
SELECT CAST(ts AS DATE) AS day,
  CAST(dense_rank() OVER (ORDER BY CAST(ts AS DATE)) AS INT) AS batch_id, count(*) AS events
FROM events GROUP BY CAST(ts AS DATE)
""")
def run_batch_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _events(spark, sf_dir).select(F.to_date("ts").alias("day"))
    batches = aggregate.run_batch_counter(dated, ["day"])
    return dated.groupBy("day").agg(F.count("*").alias("events")).join(batches, "day")


@query("""
SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'
""")
def day_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = readers.half_open_day_window(_events(spark, sf_dir), "ts", "2024-01-10")
    return rows.time_sorted(kept, "ts", "event_id").select("event_id", "ts")


@query("SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'")
def since_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = readers.read_since_cursor(_events(spark, sf_dir), "ts", "2024-01-20 12:00:00")
    return kept.select("event_id")


@query("SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-01 00:00:00'")
def since_historical_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_since_cursor(_events(spark, sf_dir), "ts", None).select("event_id")


@query("""
SELECT 'new' AS part, max(ts) AS cursor FROM events
UNION ALL SELECT 'none', TIMESTAMP '2030-01-01'
""")
def next_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position after a run with new rows, and after one without."""
    events = _events(spark, sf_dir)
    kind = events.schema["ts"].dataType

    def position(part: str, start: str) -> DataFrame:
        cursor = F.lit(start).cast(kind)
        new = readers.read_since_cursor(events, "ts", cursor)
        return aggregate.max_cursor(new, "ts", cursor).select(F.lit(part).alias("part"), "cursor")

    return position("new", "2024-01-01").unionByName(position("none", "2030-01-01"))


@query("""
SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1
""")
def range_backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing lines by day folder, a range of which is read back; other folders stay shut."""
    events = _events(spark, sf_dir).select(
        "event_id",
        F.year("ts").alias("year"),
        F.date_format("ts", "MM").alias("month"),
        F.date_format("ts", "dd").alias("day"),
    )
    path = shared_dir(spark, "landing")
    writers.write_ndjson(events, path, 5000, ["year", "month", "day"])
    landed = readers.read_ndjson(spark, path, T.StructType.fromDDL("event_id BIGINT"), by_day=True)
    kept = readers.read_day_range(landed, "2024-01-05", "2024-01-20")
    day = F.make_date("year", F.col("month").cast("int"), F.col("day").cast("int"))
    return kept.groupBy(day.alias("day")).agg(F.count("*").alias("events"))


@query("""
SELECT event_id,
  CASE WHEN event_id % 3 = 1 THEN TIMESTAMP '2024-02-01' ELSE date_trunc('second', ts)
  END AS at_or_run,
  CASE WHEN event_id % 3 = 1 THEN DATE '2024-02-01' ELSE CAST(ts AS DATE) END AS event_date,
  strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
  CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS prefix_date,
  '20240201' AS run_date, DATE '2024-01-31' AS yesterday, DATE '2024-02-02' AS tomorrow
FROM events
""")
def event_date_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch times, one or both missing, and the date parts and run days made from times."""
    seconds = F.unix_seconds(utc(F.col("ts")))
    n = F.col("event_id") % 3
    queued, completed = F.when(n == 0, seconds), F.when(n == 2, seconds)
    run = times.run_dates(AS_OF)
    return _events(spark, sf_dir).select(
        "event_id",
        F.coalesce(
            times.epoch_to_ts(queued), times.epoch_to_ts(completed), times.moment(AS_OF)
        ).alias("at_or_run"),
        times.event_date(queued, completed, AS_OF).alias("event_date"),
        *[part.alias(name) for name, part in times.date_parts(F.col("ts")).items()],
        times.date_prefix(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("prefix_date"),
        *[run[name].alias(name) for name in ("run_date", "yesterday", "tomorrow")],
    )


@query(unified_sql(
    {"source_id": "event_id", "timestamp": "ts", "event_type": "event_type",
     "user_id": "user_id", "connector_id": "'7'", "event_date": "CAST(ts AS DATE)",
     "batch_id": "NULL"},
    "events",
))
def conform_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renames, casts and typed nulls to the 47 columns."""
    named = shape.rename_map(
        _events(spark, sf_dir), {"event_id": "source_id", "ts": "timestamp", "absent": "phone"}
    )
    tagged = shape.constants(named, {"connector_id": "7"})
    cast = shape.cast_columns(tagged, {"connector_id": "int", "user_id": "string"})
    dated = cast.withColumn("event_date", F.to_date("timestamp"))
    return shape.conform_to_schema(dated, UNIFIED)


@query(f"""
WITH {tables_with_k()}
SELECT event_id, '{{"user_id":' || user_id || CASE WHEN k % 2 = 0 THEN ',"note":"n' || k || '"'
  ELSE '' END || ',"k":' || k || '}}' AS unmapped, '{config.NO_UNMAPPED}' AS none
FROM src
""")
def pack_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra columns to JSON in input order, and the mark where there are none."""
    k = F.col("k")
    wide = _with_k(spark, sf_dir).select(
        "event_id", "user_id", F.when(k % 2 == 0, text("n", k)).alias("note"), "k"
    )
    packed = shape.pack_unmapped(wide, ["event_id"])
    return shape.pack_unmapped(packed, ["event_id", "unmapped"], into="none")


@query(f"""
SELECT event_id, {id_sql("'layer_id'", "event_id", "event_type")} AS layer_id,
  {id_sql("event_id", "event_type")} AS parent_id, 'src' AS source,
  CAST(NULL AS VARCHAR) AS account_id, TIMESTAMP '2024-02-01' AS r_created_at
FROM events
""")
def lineage_and_restamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps of one layer, then of the next, which keeps the parent's id."""
    lineage = Lineage(source="src", connector_id="1")
    first = shape.add_lineage(
        _events(spark, sf_dir), lineage, "2024-01-31", "row_id", ["event_id", "event_type"]
    )
    second = shape.drop_and_restamp(
        first, AS_OF, "layer_id", ["event_id", "event_type"], {"row_id": "parent_id"}
    )
    return second.select(
        "event_id", "layer_id", "parent_id", "source", "account_id", "r_created_at"
    )


@query(f"""
WITH {tables_with_k()}
SELECT event_id, CAST(NULL AS VARCHAR) AS nothing, '{{"k":' || k || '}}' AS nested FROM src
""")
def void_columns_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped nulls, also within a struct, become text; the rest of the struct stays."""
    untyped = _with_k(spark, sf_dir).select(
        "event_id",
        F.lit(None).alias("nothing"),
        F.struct("k", F.lit(None).alias("gone")).alias("s"),
    )
    fixed = shape.fix_void_columns(untyped)
    return fixed.select("event_id", "nothing", F.to_json("s").alias("nested"))


@query(f"""
WITH {tables_with_k()}
SELECT event_id, k % 4 AS credits,
  CAST((k % 4) * CAST(0.09 AS DECIMAL(18, 4)) AS DOUBLE) AS cost
FROM src
""")
def credit_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    credits = F.col("k") % 4
    return _with_k(spark, sf_dir).select(
        "event_id",
        credits.alias("credits"),
        numbers.cost(credits, config.CREDIT_PRICE).cast("double").alias("cost"),
    )


@query("SELECT min(event_id) AS event_id, min(ts) AS ts FROM events")
def first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.first_row(_events(spark, sf_dir), "ts", "event_id").select("event_id", "ts")


@query("SELECT CAST(5 AS BIGINT) AS rows_seen, TRUE AS all_known")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any five rows: that there are five, each of them from the table."""
    some = rows.sample_rows(_events(spark, sf_dir), 5).select("event_id")
    known = _events(spark, sf_dir).select("event_id", F.lit(True).alias("known"))
    return some.join(known, "event_id", "left").agg(
        F.count("*").alias("rows_seen"),
        F.every(F.coalesce("known", F.lit(False))).alias("all_known"),
    )


@query("""
SELECT CAST(count(*) AS BIGINT) AS rows, count(*) FILTER (event_type = 'click') AS clicks
FROM events
""")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts observed while the rows are written."""
    observed, seen = aggregate.row_counts(
        _events(spark, sf_dir), "row_counts", clicks=F.col("event_type") == "click"
    )
    writers.append_unified(observed, shared_dir(spark, "counted"))
    found = aggregate.observed(seen)
    return spark.createDataFrame([(found["rows"], found["clicks"])], "rows BIGINT, clicks BIGINT")


# --- the whole job -----------------------------------------------------------------
_RAW_COLUMNS = [
    "source_event_id", "record_type", "unix_timestamp", "event_timestamp", "event_uuid",
    "metric_id", "profile_id", "campaign_id", "message_id", "phone", "destination_address",
    "source_address", "content_body", "extra_message_body", "message_name", "media_url",
    "format", "message_type", "campaign_name", "failure_type", "credits_used", "cost_usd",
    "is_spam", "bot_click", "ip_address", "full_properties_json", "raw_id", "year", "month",
    "day",
]
_RAW_SQL = ", ".join(
    "CAST(cost_usd AS VARCHAR) AS cost_usd" if c == "cost_usd" else c for c in _RAW_COLUMNS
)


@query(f"WITH {EVENT_CTES} SELECT {_RAW_SQL} FROM raw_layer")
def message_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = event_job.to_raw(message_events(spark, sf_dir), LINEAGE, AS_OF)
    return raw.select(*_RAW_COLUMNS).withColumn("cost_usd", F.col("cost_usd").cast("string"))


@query(f"""
WITH {EVENT_CTES}
SELECT source_event_id, event_name, profile_id, message_id, channel_calc, status_calc, direction,
  content_calc, optimized_id FROM optimized
""")
def message_events_optimized(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = event_job.to_raw(message_events(spark, sf_dir), LINEAGE, AS_OF)
    return event_job.to_optimized(raw, AS_OF).select(
        "source_event_id", "event_name", "profile_id", "message_id", "channel_calc",
        "status_calc", "direction", "content_calc", "optimized_id",
    )


@query(f"WITH {EVENT_CTES} {EVENT_UNIFIED}")
def message_events_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = message_events(spark, sf_dir)
    optimized = event_job.to_optimized(event_job.to_raw(documents, LINEAGE, AS_OF), AS_OF)
    return event_job.to_unified(optimized, _batches(documents), AS_OF)


@query(f"WITH {EVENT_CTES} {EVENT_UNIFIED}")
def message_events_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on files, from landing lines to the unified layer, run twice."""
    layers, days = _landed(spark, sf_dir)
    for _ in range(2):
        event_job.run(spark, layers, *days, LINEAGE, dt.datetime(2024, 2, 1))
    return _unified_layer(spark, layers)


def _landed(spark: SparkSession, sf_dir: str) -> tuple[event_job.Layers, list[dt.date]]:
    """All documents landed in a fresh folder, with their first and last day."""
    base = shared_dir(spark, "backfill")
    layers = event_job.Layers(*[f"{base}/{n}" for n in ("landing", "raw", "opt", "unified", "log")])
    writers.write_ndjson(
        message_events(spark, sf_dir), layers.landing, 100_000, ["year", "month", "day"], "gzip"
    )
    day = F.to_date("ts")
    first, last = _events(spark, sf_dir).agg(F.min(day), F.max(day)).first()
    return layers, [first or dt.date(2024, 1, 1), last or dt.date(2024, 1, 1)]


def _unified_layer(spark: SparkSession, layers: event_job.Layers) -> DataFrame:
    unified = readers.read_layer(spark, layers.unified).drop("landing_day")
    return shape.conform_to_schema(unified, UNIFIED)


@query(f"""
WITH {EVENT_CTES}, loaded AS ({EVENT_UNIFIED})
SELECT l.* FROM loaded l JOIN landed d ON 'e' || d.event_id = l.source_id
WHERE CAST(d.ts AS DATE) <> (SELECT min(CAST(ts AS DATE)) FROM events)
QUALIFY row_number() OVER (PARTITION BY d.event_id) = 1
""")
def backfill_of_a_day_loaded_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day is landed again with unknown events only: its rows go from every layer."""
    layers, days = _landed(spark, sf_dir)
    event_job.run(spark, layers, *days, LINEAGE, dt.datetime(2024, 2, 1))
    day = F.make_date("year", F.col("month").cast("int"), F.col("day").cast("int"))
    first = message_events(spark, sf_dir).filter(day == F.lit(days[0]))
    unknown = F.struct(F.struct(F.lit("none").alias("id")).alias("data")).alias("metric")
    links = F.struct(unknown, F.col("relationships.profile").alias("profile"))
    writers.write_ndjson(
        first.withColumn("relationships", links), layers.landing, 100_000, ["year", "month", "day"], "gzip"
    )
    event_job.run(spark, layers, *days, LINEAGE, dt.datetime(2024, 2, 1))
    return _unified_layer(spark, layers)


@query(f"""
WITH {EVENT_CTES.replace("PARTITION BY year, month, day, profile_id", "PARTITION BY profile_id")}
SELECT source_event_id, status_calc FROM optimized
""")
def first_clicks_over_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First clicks over the whole range in place of each landing day."""
    settings = EventSettings(day_columns=())
    raw = event_job.to_raw(message_events(spark, sf_dir), LINEAGE, AS_OF, settings)
    return event_job.to_optimized(raw, AS_OF, settings).select("source_event_id", "status_calc")
