"""Message-event backfill: landing → raw → optimized → unified, a range of days at once.

Repeated ids and first clicks are looked up within a landing day, so a whole range in one
job gives the rows that day-by-day runs give.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from msgloom.config import UNKNOWN_EVENT, EventSettings, Lineage
from msgloom.functions.numbers import cost
from msgloom.functions.text import first_non_null, json_of, row_id
from msgloom.functions.times import When, date_prefix, moment
from msgloom.operators import aggregate, classify, dedup, shape
from msgloom.schemas import MESSAGE_EVENT, UNIFIED
from msgloom.sinks import writers
from msgloom.sources import readers
from msgloom.sources.unknown import UNKNOWN, read_ndjson_keeping_unknown

PROPERTIES = "attributes.event_properties"
DAY = ("year", "month", "day")
METRIC = "relationships.metric.data.id"


def _property(name: str) -> Column:
    return F.col(f"attributes.event_properties.`{name}`")


def to_raw(
    landed: DataFrame, lineage: Lineage, as_of: When, settings: EventSettings = EventSettings()
) -> DataFrame:
    """Known events as 26 flat columns, with lineage, their landing day and fields kept as unknown."""
    known = classify.filter_in(landed, METRIC, list(settings.names))
    code = F.col(METRIC)
    credits = classify.choose_by_code(
        code, settings.usage_codes, _property("$usage_amount"), _property("Credits")
    )
    fields = {
        "source_event_id": ("id", "string"),
        "record_type": ("type", "string"),
        "unix_timestamp": ("attributes.timestamp", "int"),
        "event_timestamp": ("attributes.datetime", "string"),
        "event_uuid": ("attributes.uuid", "string"),
        "metric_id": (METRIC, "string"),
        "profile_id": (
            first_non_null(
                F.col("relationships.profile.data.id"), F.col("attributes.profile_id")
            ),
            "string",
        ),
        "campaign_id": (_property("$campaign"), "string"),
        "message_id": (_property("$message"), "string"),
        "phone": (
            classify.choose_by_code(
                code,
                settings.from_number_codes,
                _property("From Number"),
                _property("To Number"),
            ),
            "string",
        ),
        "destination_address": (_property("To Number"), "string"),
        "source_address": (_property("From Number"), "string"),
        "content_body": (_property("Message Body"), "string"),
        "extra_message_body": (_property("$extra")["Message Body"], "string"),
        "message_name": (_property("Message Name"), "string"),
        "media_url": (_property("Image URL"), "string"),
        "format": (_property("Message Format"), "string"),
        "message_type": (_property("Message Type"), "string"),
        "campaign_name": (_property("Campaign Name"), "string"),
        "failure_type": (_property("Failure Type"), "string"),
        "credits_used": (credits, "int"),
        "cost_usd": (cost(credits, settings.credit_price, settings.cost_type), settings.cost_type),
        "is_spam": (_property("is_spam"), "boolean"),
        "bot_click": (_property("Bot Click"), "boolean"),
        "ip_address": (_property("$extra")["IP Address"], "string"),
        "full_properties_json": (json_of(F.col("attributes.event_properties")), "string"),
        "year": ("year", "int"),
        "month": ("month", "string"),
        "day": ("day", "string"),
    }
    if UNKNOWN in landed.columns:
        fields[UNKNOWN] = (UNKNOWN, "variant")
    flat = shape.flatten_nested(known, fields)
    stamped = shape.add_lineage(flat, lineage, as_of, "raw_id", ["source_event_id", *DAY])
    return shape.fix_void_columns(stamped.drop("r_updated_at"))


def to_optimized(
    raw: DataFrame,
    as_of: When,
    settings: EventSettings = EventSettings(),
    gather: Sequence[str] = (),
) -> DataFrame:
    """Each event once, without bot clicks, only the first click of a profile on a message.

    ``gather`` names folders that the rows are gathered by for writing; that comes before the
    new columns, which are then not shuffled.
    """
    scope = list(settings.day_columns)
    once = dedup.dedup_by_key(
        raw, [*scope, "source_event_id"], ["unix_timestamp", "full_properties_json"]
    )
    named = once.withColumn(
        "event_name", classify.map_codes(F.col("metric_id"), settings.names, UNKNOWN_EVENT)
    )
    is_click = F.col("event_name") == settings.click_event
    human = classify.drop_bots(named, "bot_click", where=is_click)
    touched = dedup.first_touch(
        human,
        [*scope, "profile_id", "message_id"],
        ["unix_timestamp", "source_event_id"],
        where=is_click,
    )
    if gather:
        touched = writers.compact(touched, *gather)
    code = F.col("metric_id")
    return touched.withColumns(
        {
            "channel_calc": F.lit(settings.channel),
            "status_calc": classify.map_status(F.col("event_name"), settings.statuses),
            "direction": classify.map_direction(F.col("event_name"), settings.inbound_events),
            "content_calc": F.when(
                code.isin(*settings.extra_body_codes), F.col("extra_message_body")
            )
            .when(code.isin(*settings.no_body_codes), F.lit(None))
            .otherwise(first_non_null(F.col("content_body"), F.col("message_name"))),
            "optimized_id": row_id(F.lit("optimized"), F.col("raw_id")),
            "r_created_at_opt": moment(as_of),
        }
    )


def to_unified(
    optimized: DataFrame,
    batches: DataFrame,
    as_of: When,
    settings: EventSettings = EventSettings(),
    keep_day: bool = False,
) -> DataFrame:
    """Allowed statuses as the 47-column contract.

    ``batches`` numbers the landing days; ``keep_day`` adds the landing day as a column to
    write the layer by.
    """
    allowed = classify.status_allow_list(
        optimized, "status_calc", list(settings.statuses.values())
    )
    landing_day = F.concat_ws("-", F.col("year").cast("string"), "month", "day")
    dated = allowed.withColumns(
        {"event_date": date_prefix(F.col("event_timestamp")), "landing_day": landing_day}
    )
    named = shape.rename_map(dated, settings.renames)
    tagged = shape.constants(named, settings.campaign_tags)
    now = moment(as_of)
    ready = tagged.withColumns(
        {
            "event_type": F.col("channel_calc"),
            "channel": F.col("channel_calc"),
            "id": row_id(F.lit("unified"), F.col("optimized_id")),
            "r_created_at": now,
            "r_updated_at": now,
        }
    )
    packed = shape.pack_unmapped(ready, [*UNIFIED.fieldNames(), "landing_day"])
    typed = shape.cast_columns(packed, {"connector_id": "int", "timestamp": "timestamp"})
    # One row per calendar day, a megabyte for a century. Without the hint Spark would size
    # it by the input it was counted from and shuffle all events by their few days.
    days = batches.select(landing_day.alias("landing_day"), "batch_id")
    numbered = typed.join(F.broadcast(days), "landing_day", "left")
    return shape.conform_to_schema(numbered, UNIFIED, ["landing_day"] if keep_day else [])


@dataclass(frozen=True)
class Layers:
    landing: str
    raw: str
    optimized: str
    unified: str
    run_log: str


def _present_days(landed: DataFrame) -> list[tuple]:
    """The days that have landed lines; from the folders alone where Spark can tell."""
    return sorted(tuple(row) for row in landed.select(*DAY).distinct().collect())


def _of_days(layer: DataFrame, days: list[tuple]) -> DataFrame:
    """The layer's rows of some days; other folders are not opened."""
    day = F.concat_ws("-", *[F.col(c).cast("string") for c in DAY])
    return layer.filter(day.isin(["-".join(map(str, d)) for d in days]))


def run(
    spark: SparkSession,
    layers: Layers,
    start: dt.date,
    end: dt.date,
    lineage: Lineage,
    as_of: dt.datetime,
    settings: EventSettings = EventSettings(),
) -> dict:
    """Backfill an inclusive range of days; running a day again replaces its rows.

    The unified layer is written by connector and landing day: an event whose own date
    lies in another day then never replaces rows that came with that day.
    """
    run_id = f"events-{start:%Y%m%d}-{end:%Y%m%d}-{as_of:%Y%m%dT%H%M%S}"
    metrics: dict[str, int] = {}
    log = dict(run_id=run_id, job="events", as_of=as_of, metrics=metrics,
               start_cursor=str(start), end_cursor=str(end))
    try:
        if settings.keep_unknown:
            landed = read_ndjson_keeping_unknown(
                spark, layers.landing, MESSAGE_EVENT, [PROPERTIES], by_day=True
            )
        else:
            landed = readers.read_ndjson(
                spark, layers.landing, MESSAGE_EVENT, by_day=True, corrupt=True
            )
        landed = readers.read_day_range(landed, start, end)
        seen = Observation(f"{run_id}-landing")
        counted = landed.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count(readers.CORRUPT).alias("corrupt")
        )
        raw = to_raw(counted, lineage, as_of, settings)
        # Only days that have landed are replaced, all their rows gone included; a day whose
        # landing is no longer there keeps the rows it has.
        present = _present_days(landed)
        writers.replace_partitions(raw, layers.raw, DAY, present, f"{run_id}-raw")
        metrics["landing_rows"] = aggregate.observed(seen).get("rows", 0)
        metrics["corrupt_lines"] = aggregate.observed(seen).get("corrupt", 0)
        days = spark.createDataFrame(present, "year INT, month STRING, day STRING")
        batches = aggregate.run_batch_counter(days, list(DAY))

        # After a shuffle every task holds rows of every day: gather them by day before
        # writing, or each day would get a file from each task.
        raw = _of_days(readers.read_layer(spark, layers.raw, raw.schema), present)
        optimized = to_optimized(raw, as_of, settings, DAY)
        counted, seen = aggregate.row_counts(optimized, f"{run_id}-optimized")
        writers.replace_partitions(counted, layers.optimized, DAY, present, f"{run_id}-days")
        metrics["optimized_rows"] = aggregate.observed(seen).get("rows", 0)

        done = _of_days(readers.read_layer(spark, layers.optimized, optimized.schema), present)
        unified = to_unified(done, batches, as_of, settings, keep_day=True)
        keys = ["connector_id", "landing_day"]
        # The optimized files hold one day each, and a task that reads some of them holds few
        # days: its rows are written as they come, without a shuffle.
        unified, seen = aggregate.row_counts(unified, f"{run_id}-unified")
        folders = [(int(lineage.connector_id), "-".join(map(str, day))) for day in present]
        writers.replace_partitions(unified, layers.unified, keys, folders, f"{run_id}-folders")
        metrics["unified_rows"] = aggregate.observed(seen).get("rows", 0)
    except Exception as error:
        writers.write_run_log(spark, layers.run_log, error=str(error), **log)
        raise
    writers.write_run_log(spark, layers.run_log, total_records=metrics["landing_rows"], **log)
    return metrics
