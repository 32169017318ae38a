"""Notification job: landing → raw → optimized campaign figures → unified contract.

``to_raw``, ``to_optimized`` and ``to_unified`` are plans without side effects; ``run``
writes each layer once and reads the next one from it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom import config
from msgloom.config import Lineage
from msgloom.functions.numbers import counter, pct
from msgloom.functions.text import (
    first_non_null,
    join_or_default,
    json_of,
    lang_text,
    strip_template,
)
from msgloom.functions.times import When, epoch_to_ts, event_date, moment, run_dates
from msgloom.operators import aggregate, classify, dedup, known_ids, shape
from msgloom.schemas import NOTIFICATION, OPTIMIZED_CAMPAIGN, UNIFIED
from msgloom.session import shared_dir, shuffles_freed
from msgloom.sinks import writers
from msgloom.sources import readers

COUNTERS = ("successful", "failed", "errored", "converted", "received")
JOB = "notifications"
# The file that a landed record stands in; not one of the record's own fields.
FILE = "_landed_file"


def to_raw(
    landed: DataFrame, lineage: Lineage, as_of: When, batch_id: int, path: str | None = None
) -> DataFrame:
    """Landed records with lineage, typed times, channel and the message text.

    The id is made of the whole record: a change in any field is another version. The path is
    the record's own file where the reader gives it, else the one given.
    """
    now = moment(as_of)
    whole = [
        F.to_json(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        else F.col(f.name)
        for f in landed.schema.fields if f.name != FILE
    ]
    source = F.col(FILE) if FILE in landed.columns else F.lit(path).cast("string")
    raw = shape.add_lineage(
        landed,
        lineage,
        as_of,
        "record_id",
        whole,
        batch_id=F.lit(batch_id),
        processing_date=run_dates(as_of)["run_date"],
        data_source_path=source,
        file_processed_at=now,
        event_date=event_date(F.col("queued_at"), F.col("completed_at"), as_of),
        eventtype=classify.classify_channel(F.col("isEmail"), F.col("isSMS")),
        content_text=lang_text(F.col("contents")),
        **{
            f"{c}_timestamp": epoch_to_ts(F.col(c))
            for c in ("queued_at", "send_after", "completed_at")
        },
    )
    return shape.fix_void_columns(raw.drop(FILE))


def _newest() -> list[Column]:
    """Order of the versions of a notification; those that tie in it have equal figures."""
    newest = [F.desc(c) for c in ("file_processed_at", "completed_at", "queued_at", *COUNTERS)]
    return [*newest, F.asc("eventtype")]


def _counts() -> dict[str, Column]:
    return {
        "sends": counter(F.col("successful"), F.col("failed"), F.col("errored")),
        "delivered": counter(F.col("successful")),
        "failed_count": counter(F.col("failed")),
        "rejected": counter(F.col("errored")),
        "total_failed": counter(F.col("failed"), F.col("errored")),
        "clicks": counter(F.col("converted")),
    }


def _rates() -> dict[str, Column]:
    return {
        "success_rate": pct(F.col("delivered"), F.col("sends")),
        "click_through_rate": pct(F.col("clicks"), F.col("delivered")),
    }


def channel_figures(raw: DataFrame) -> DataFrame:
    """Counts and rates of each notification and run day, as in the optimized layer.

    For summaries: ids made of the whole record and all texts are left out, so the scan and the
    shuffle hold the few columns that the figures need. Versions that tie in these have equal
    figures, so that it does not matter which of them stays.
    """
    once = dedup.dedup_by_key(raw, ["processing_date", "id"], _newest())
    named = {"campaign_id": F.col("id"), "send_date": F.col("event_date"), "message_type": F.col("eventtype")}
    figures = once.withColumns({**_counts(), **named}).withColumns(_rates())
    return figures.select("processing_date", *named, *_counts(), *_rates())


def to_optimized(raw: DataFrame, as_of: When, batch_id: int) -> DataFrame:
    """One row per notification and run day with the campaign figures, 39 columns."""
    once = dedup.dedup_by_key(raw, ["processing_date", "id"], [*_newest(), "record_id"])
    own = shape.drop_and_restamp(
        once, as_of, "opt_id", ["id", "raw_record_id"], {"record_id": "raw_record_id"}
    )
    channel = F.col("eventtype")
    figures = own.withColumns(
        {
            "batch_id": F.lit(batch_id),
            **_counts(),
            "campaign_id": F.col("id"),
            "campaign_name": first_non_null(F.col("name"), F.lit(config.DEFAULT_CAMPAIGN)),
            "audience_segments": join_or_default(
                F.col("included_segments"), config.DEFAULT_AUDIENCE
            ),
            "send_date": F.col("event_date"),
            "send_datetime": F.col("queued_at_timestamp"),
            "message_type": channel,
            "sending_number": F.when(channel == "SMS", F.col("sms_from")),
            "creative_content": F.col("content_text"),
            "creative_title": lang_text(F.col("headings")),
            "content_text_clean": strip_template(F.col("content_text")),
            "replies": F.lit(None).cast("int"),
            "primary_link": first_non_null(F.col("url"), F.col("web_url"), F.col("app_url")),
            "platform_stats": json_of(F.col("platform_delivery_stats")),
            "delivery_status": classify.delivery_status(
                F.col("canceled"), F.col("completed_at_timestamp")
            ),
            "has_links": classify.has_link(
                [F.col("url"), F.col("web_url"), F.col("app_url")], F.col("content_text")
            ),
        }
    ).withColumns(
        {
            "recipient_count": F.col("sends"),
            **_rates(),
            "links_shortened": classify.link_shortened(F.col("primary_link")),
            "sms_metrics": F.when(
                channel == "SMS",
                json_of(
                    F.struct(
                        F.col("delivered").alias("sms_delivered"),
                        F.col("failed_count").alias("sms_failed"),
                        F.col("sending_number").alias("sms_from_number"),
                    )
                ),
            ),
            "email_metrics": F.when(
                channel == "EMAIL",
                json_of(
                    F.struct(
                        F.col("delivered").alias("email_delivered"),
                        F.col("clicks").alias("email_clicks"),
                        "email_subject",
                    )
                ),
            ),
            "push_metrics": F.when(
                channel == "PUSH_NOTIFICATION",
                json_of(
                    F.struct(
                        F.col("delivered").alias("push_delivered"),
                        F.col("clicks").alias("push_clicks"),
                        "priority",
                    )
                ),
            ),
        }
    )
    return shape.fix_void_columns(shape.select_contract(figures, OPTIMIZED_CAMPAIGN))


def to_unified(optimized: DataFrame, as_of: When, batch_id: int) -> DataFrame:
    """Optimized rows as the 47-column contract; all other columns go into ``unmapped``."""
    stamped = shape.drop_and_restamp(optimized, as_of, "id", ["opt_id"])
    named = shape.rename_map(stamped, config.NOTIFICATION_RENAMES)
    packed = shape.pack_unmapped(named, UNIFIED.fieldNames())
    typed = shape.cast_columns(
        packed,
        {"connector_id": "int", "timestamp": "timestamp"},
        {"timestamp": moment(as_of)},
    )
    return shape.conform_to_schema(typed.withColumn("batch_id", F.lit(batch_id)), UNIFIED)


@dataclass(frozen=True)
class Layers:
    """Where the layers are. ``table`` is a catalog table, ``table_path`` its folder.

    Landed files that cannot be read are kept in ``quarantine``, and counted in any case.
    With ``known_ids``, a folder for Bloom filters of raw's ids, versions that raw holds are
    looked up in the run days that the filters name, and raw's other days stay closed.
    """

    landing: str
    raw: str
    optimized: str
    table: str
    run_log: str
    table_path: str | None = None
    quarantine: str | None = None
    known_ids: str | None = None


def existing_layer(spark: SparkSession, path: str) -> DataFrame | None:
    """A layer, or None before its first write."""
    try:
        return readers.read_layer(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _next_batch(layer: DataFrame | None) -> int:
    if layer is None:
        return 1
    return aggregate.next_batch_id(layer).first()[0]


def _taken_up(spark: SparkSession, run_log: str, step: str) -> int:
    """The highest batch that a step has worked off, by the log of all runs, failed ones too."""
    runs = existing_layer(spark, run_log)
    if runs is None:
        return 0
    return runs.filter(F.col("job") == JOB).agg(F.max(F.col("metrics")[step])).first()[0] or 0


def _days_since(layer: DataFrame, batch: int) -> list[str]:
    """The run days that hold batches after the given one: what is still to be worked off.

    Batch numbers rise with the files, so their statistics leave out the older ones. One
    value per calendar day comes to the driver.
    """
    found = layer.filter(F.col("batch_id") > batch).select("processing_date").distinct()
    return sorted(str(row[0]) for row in found.collect())


def newest_campaigns(optimized: DataFrame) -> DataFrame:
    """The current row of each campaign: that of its last run day."""
    key = F.coalesce("campaign_id", "opt_id")
    order = [F.desc("processing_date"), F.desc("batch_id"), "opt_id"]
    return dedup.keep_first(optimized.withColumn("_campaign", key), ["_campaign"], order).drop("_campaign")


def merge_current(spark: SparkSession, table: str, new: DataFrame, partitions: list[str]) -> None:
    """Put the current rows of some campaigns into the table, in place of their older ones.

    Only the partitions that hold old or new rows of these campaigns are written, from a
    copy beside the table, as the table is read for it. The copy stays until all are replaced,
    and ``finish_merges`` takes up one that a failure has left.
    """
    finish_merges(spark, table, partitions)
    campaign = F.coalesce("campaign_id", "source_id")
    held = spark.table(table)
    keys = new.select(campaign.alias("_campaign")).distinct()
    stale = held.withColumn("_campaign", campaign).join(keys, "_campaign", "left_semi")
    folders = stale.select(*partitions).unionByName(new.select(*partitions)).distinct()
    present = [tuple(row) for row in folders.collect()]  # one entry per calendar day
    # The days prune the folders that are read; a connector's other days stay closed.
    touched = held.filter(F.col(partitions[-1]).isin([p[-1] for p in present]))
    kept = touched.withColumn("_campaign", campaign).join(keys, "_campaign", "left_anti")
    merged = kept.drop("_campaign").unionByName(new.select(*held.columns))
    copy = f"{_merges(spark, table)}/{uuid.uuid4().hex[:12]}"
    with shuffles_freed(spark):
        merged.write.option("compression", "zstd").parquet(f"{copy}/rows")
    # Written last: a copy that has this list is whole.
    kinds = T.StructType([T.StructField(p, held.schema[p].dataType) for p in partitions])
    spark.createDataFrame(present, kinds).coalesce(1).write.parquet(f"{copy}/present")
    _finish_merge(spark, table, copy, partitions)


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def _merges(spark: SparkSession, table: str) -> str:
    """The folder of the table's merges that are on their way, beside its own."""
    return f"{_location(spark, table).rstrip('/')}-merges"


def _finish_merge(spark: SparkSession, table: str, copy: str, partitions: list[str]) -> None:
    """Replace the touched partitions by those of the copy; may be done again at any point."""
    held = spark.table(table)
    rows = spark.read.schema(held.schema).parquet(f"{copy}/rows").select(*held.columns)
    present = [tuple(row) for row in spark.read.parquet(f"{copy}/present").select(*partitions).collect()]
    writers.replace_partitions(
        writers.compact(rows, *partitions), _location(spark, table), partitions, present, f"merge-{copy[-12:]}"
    )
    # The catalog lists the partitions: new ones are entered, removed ones struck out.
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    writers.remove_folder(spark, copy)


def finish_merges(spark: SparkSession, table: str, partitions: list[str]) -> int:
    """Finish what a failed run has left: whole copies are put in place, others removed.

    A merge that failed while it replaced folders has its rows in its copy, those of other
    campaigns included, so that putting them in place once more loses nothing.
    """
    if not spark.catalog.tableExists(table):
        return 0
    done = 0
    for copy in writers.folders_in(spark, _merges(spark, table)):
        if writers.is_written(spark, f"{copy}/present"):
            _finish_merge(spark, table, copy, partitions)
            done += 1
        else:
            writers.remove_folder(spark, copy)
    return done


def _not_known(
    spark: SparkSession, raw: DataFrame, known: DataFrame, layers: Layers, work: str
) -> DataFrame:
    """The landed rows whose version raw lacks.

    The landed ids alone are written to ``work`` and looked up, so that whole records are
    neither shuffled nor sorted for it. Those found new are written there too: few of them
    are broadcast to a second reading of the files, and none make it needless.
    """
    raw.select("record_id").write.option("compression", "zstd").parquet(f"{work}/landed")
    ids = spark.read.schema("record_id STRING").parquet(f"{work}/landed")
    if layers.known_ids:
        held = readers.read_layer(spark, layers.raw, raw.schema)
        known_ids.complete(held, "record_id", "processing_date", layers.known_ids)
        parts = known_ids.read_parts(spark, layers.known_ids)
        new = known_ids.anti_new_rows_by_filter(
            ids, held, "record_id", "processing_date", parts, f"{work}/known"
        )
    else:
        new = dedup.anti_new_rows(ids, known, "record_id")
    with shuffles_freed(spark):
        new.distinct().write.option("compression", "zstd").parquet(f"{work}/new")
    found = spark.read.schema("record_id STRING").parquet(f"{work}/new")
    if found.isEmpty():
        return raw.filter(F.lit(False))
    return raw.join(found, "record_id", "left_semi")


def run(
    spark: SparkSession,
    layers: Layers,
    lineage: Lineage,
    as_of: dt.datetime,
    modified_after: str | None = None,
) -> dict:
    """One run over all layers; the counts of each are logged, and an error is raised again.

    Landed versions that raw holds already are left out. Each later step works off the run
    days with batches that the log does not show as done, whichever run wrote them, so that
    nothing is lost after a failure at any point. The table holds one current row per
    campaign. ``modified_after`` spares reading the files of runs long done.
    """
    run_id = f"{JOB}-{as_of:%Y%m%dT%H%M%S}"
    metrics: dict[str, int] = {}
    log = dict(run_id=run_id, job=JOB, as_of=as_of, metrics=metrics)
    try:
        known = existing_layer(spark, layers.raw)
        torn = Observation(f"{run_id}-landing")
        landed, bad = readers.read_checked_notifications(
            spark, layers.landing, NOTIFICATION, modified_after, FILE, torn
        )
        raw = to_raw(landed, lineage, as_of, _next_batch(known), layers.landing)
        work = None
        if known is not None:
            work = shared_dir(spark, "landed-ids")
            raw = _not_known(spark, raw, known, layers, work)
        kinds = ("EMAIL", "SMS", "PUSH_NOTIFICATION")
        channels = {kind.lower(): F.col("eventtype") == kind for kind in kinds}
        counted, seen = aggregate.row_counts(raw, f"{run_id}-raw", **channels)
        writers.append_layer(counted, layers.raw)
        metrics.update({f"raw_{k}": v for k, v in aggregate.observed(seen).items()})
        if work:
            writers.remove_folder(spark, work)
        metrics["quarantined"] = aggregate.observed(torn).get("bad", 0)
        if layers.quarantine and metrics["quarantined"]:
            bad.write.mode("overwrite").parquet(f"{layers.quarantine}/run_id={run_id}")

        raw = readers.read_layer(spark, layers.raw, raw.schema)
        if layers.known_ids:
            known_ids.complete(raw, "record_id", "processing_date", layers.known_ids)
        highest = _next_batch(raw) - 1
        days = _days_since(raw, _taken_up(spark, layers.run_log, "optimized_batch"))
        pending = raw.filter(F.col("processing_date").isin(days))
        optimized = to_optimized(pending, as_of, _next_batch(existing_layer(spark, layers.optimized)))
        metrics["optimized_rows"] = 0
        if days:
            counted, seen = aggregate.row_counts(optimized, f"{run_id}-optimized")
            writers.overwrite_partitions(counted, layers.optimized, ["processing_date"])
            metrics["optimized_rows"] = aggregate.observed(seen).get("rows", 0)
        metrics["optimized_batch"] = highest

        done = readers.read_layer(spark, layers.optimized, optimized.schema)
        highest = _next_batch(done) - 1
        days = _days_since(done, _taken_up(spark, layers.run_log, "unified_batch"))
        metrics["unified_rows"] = 0
        if days:
            # Kept, as several reads need it and the next shuffle need not stand beside this one's.
            work = shared_dir(spark, "current")
            current = newest_campaigns(done.filter(F.col("processing_date").isin(days)))
            with shuffles_freed(spark):
                current.write.option("compression", "zstd").parquet(f"{work}/rows")
            current = readers.read_layer(spark, f"{work}/rows", current.schema)
            number = (readers.read_catalog_max(spark, layers.table, "batch_id") or 0) + 1
            unified = to_unified(current, as_of, number)
            partitions = ["connector_id", "event_date"]
            if spark.catalog.tableExists(layers.table):
                metrics["unified_rows"] = unified.count()
                merge_current(spark, layers.table, unified, partitions)
            else:
                # Gathered before they are widened: the shuffle holds each value once.
                gathered = writers.compact(current, "connector_id", "send_date")
                unified = to_unified(gathered, as_of, number)
                unified, seen = aggregate.row_counts(unified, f"{run_id}-unified")
                writers.append_table(unified, layers.table, partitions, layers.table_path)
                metrics["unified_rows"] = aggregate.observed(seen).get("rows", 0)
            writers.remove_folder(spark, work)
        metrics["unified_batch"] = highest
    except Exception as error:
        writers.write_run_log(spark, layers.run_log, error=str(error), **log)
        raise
    writers.write_run_log(
        spark, layers.run_log, total_records=metrics.get("raw_rows", 0), **log
    )
    return metrics
