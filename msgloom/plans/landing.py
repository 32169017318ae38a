"""Incremental landing: new records since a saved position, as capped files, with a run log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom import config
from msgloom.functions.times import When, date_parts, moment
from msgloom.operators import aggregate, dedup, numbering
from msgloom.plans.notifications import existing_layer
from msgloom.session import shared_dir, shuffles_freed
from msgloom.sinks import writers
from msgloom.sources import readers


def envelopes(
    records: DataFrame, per_document: int, source: str, as_of: When, order: list[str] | None = None
) -> DataFrame:
    """Records packed into JSON documents of ``per_document`` each, the last one of the rest.

    Batch numbers run from 1 through the whole run without gaps. Records stay in the order in
    which they come, or are put in the given order by ranges. They are written once with their
    places, so that numbers hold for tasks that run again, and shuffled once, by document. No
    task numbers all rows, and no group is larger than one document.
    """
    if order:
        records = records.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("_record")
    placed = numbering.numbered(records.select(fields), shared_dir(records.sparkSession, "places"), "_number")
    document = (F.floor((F.col("_number") - 1) / per_document) + 1).cast("int").alias("_document")
    held = placed.groupBy(document).agg(F.collect_list(F.struct("_number", "_record")).alias("_held"))
    # Maps have no order, so that records are put in order by their numbers only.
    data = F.array_sort("_held", lambda a, b: (a["_number"] - b["_number"]).cast("int"))
    stamp = F.date_format(moment(as_of), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return held.select(
        F.struct(
            F.col("_document").alias("batch_number"),
            F.size("_held").alias("record_count"),
            stamp.alias("ingestion_timestamp"),
            F.lit(source).alias("source"),
        ).alias("metadata"),
        F.transform(data, lambda pair: pair["_record"]).alias("data"),
    )


def write_envelopes(documents: DataFrame, path: str) -> None:
    """One pretty-printed document per file, compressed: its many blanks and names cost nothing."""
    text = F.to_json(F.struct("metadata", "data"), {"pretty": "true"}).alias("value")
    writer = documents.select(text).write.mode("overwrite").option("maxRecordsPerFile", 1)
    with shuffles_freed(documents.sparkSession):
        writer.text(path, compression="gzip")


def last_cursor(spark: SparkSession, run_log: str, job: str) -> str | None:
    """Position after the newest completed run of a job."""
    runs = existing_layer(spark, run_log)
    if runs is None:
        return None
    done = runs.filter((F.col("job") == job) & (F.col("status") == "completed"))
    return done.agg(F.max_by("end_cursor", F.struct("run_timestamp", "run_id"))).first()[0]


def _not_landed(
    spark: SparkSession,
    records: DataFrame,
    ts: str,
    cursor: str | None,
    landing: str,
    key: str,
    overlap: dt.timedelta,
    run_id: str,
) -> DataFrame:
    """Rows from the overlap before the position on whose key no earlier run has landed there.

    Of the landed files only the days from the overlap on, and the folder of rows without a
    day, are opened.
    """
    if not cursor:
        return records
    since = F.lit(cursor).cast("timestamp") - F.expr(f"INTERVAL {int(overlap.total_seconds())} SECONDS")
    given = F.col(ts)
    kept = records.filter(given.isNull() | (given >= since.cast(records.schema[ts].dataType)))
    fields = [T.StructField(key, records.schema[key].dataType)]
    fields += [T.StructField(c, T.StringType()) for c in ("run", "year", "month", "day")]
    landed = readers.read_ndjson(spark, landing, T.StructType(fields))
    day = F.make_date(*[F.col(c).try_cast("int") for c in ("year", "month", "day")])
    near = landed.filter((F.col("run") != run_id) & (day.isNull() | (day >= F.to_date(since))))
    return dedup.anti_new_rows(kept, near, key)


def run(
    spark: SparkSession,
    records: DataFrame,
    ts: str,
    landing: str,
    run_log: str,
    as_of: dt.datetime,
    job: str = "landing",
    max_records: int = config.EVENT_PAGE,
    start: str | None = None,
    key: str | None = None,
    overlap: dt.timedelta = dt.timedelta(0),
) -> dict:
    """Land what came since the saved position; without one, everything or from ``start``.

    With a ``key``, rows at the very position, rows up to ``overlap`` before it and rows
    without a time are looked up by it among those landed already, so that late ones are
    not lost and none comes twice; without it only later rows land, and the metrics count
    the rows at the position, before it and without a time. The files go to a folder of the run and replace it: a run that
    failed before its log row is simply repeated. Without new records the position stays.
    """
    run_id = f"{job}-{as_of:%Y%m%dT%H%M%S}"
    cursor = last_cursor(spark, run_log, job) or start
    metrics: dict[str, int] = {}
    try:
        if key:
            new = _not_landed(spark, records, ts, cursor, landing, key, overlap, run_id)
        else:
            new = readers.read_since_cursor(records, ts, cursor) if cursor else records.dropna(subset=[ts])
            left = readers.left_by_cursor(records, ts, cursor).first()
            counted = ("at_position", "before_position", "without_time") if cursor else ("without_time",)
            metrics.update({name: left[name] for name in counted})
        days = date_parts(F.col(ts))
        seen = Observation(run_id)
        # Moments are compared, as a position may be written in several ways; late rows do not
        # set it back.
        newest = F.max(F.col(ts).cast("timestamp"))
        if cursor:
            newest = F.greatest(newest, F.lit(cursor).cast("timestamp"))
        position = F.date_format(newest, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("position")
        out = new.withColumns({"run": F.lit(run_id), **days}).observe(
            seen, F.count(F.lit(1)).alias("rows"), position
        )
        writers.write_ndjson(out, landing, max_records, ["run", *days])
        found = aggregate.observed(seen)
        total = metrics["records"] = found.get("rows", 0)
        end = found.get("position") if total else cursor
        end = end or cursor
    except Exception as error:
        writers.write_run_log(
            spark, run_log, run_id, job, as_of, start_cursor=cursor, error=str(error)
        )
        raise
    writers.write_run_log(spark, run_log, run_id, job, as_of, metrics, total, cursor, end)
    return {"records": total, "start_cursor": cursor, "end_cursor": end}


def day_window_records(records: DataFrame, ts: str, day: When, tie: Column | str) -> DataFrame:
    """One day's records, ``[day, day + 1)``, in time order."""
    return readers.half_open_day_window(records, ts, day).orderBy(ts, tie)
