"""Dedup of a stream that keeps and counts what comes too late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from msgloom.operators import dedup
from msgloom.operators.aggregate import observed
from msgloom.plans.notifications import existing_layer

# One row for each micro-batch: its newest time and what became of its rows.
MARKS = T.StructType([
    T.StructField("newest", T.TimestampType()),
    T.StructField("rows", T.LongType()),
    T.StructField("kept", T.LongType()),
    T.StructField("late", T.LongType()),
    T.StructField("repeats", T.LongType()),
])
BATCH = "ingest_batch"


def _replace(df: DataFrame, path: str, number: int) -> None:
    """The micro-batch's own partition, in place of what an attempt before has left."""
    (
        df.withColumn(BATCH, F.lit(number))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(path)
    )


def _marks_before(spark: SparkSession, path: str, number: int) -> list[tuple]:
    """Number and newest time of the micro-batches before, a row each."""
    marks = existing_layer(spark, path)
    if marks is None:
        return []
    before = marks.filter(F.col(BATCH) < number).groupBy(BATCH).agg(F.max("newest"))
    return [tuple(row) for row in before.collect()]


def stream_dedup_keeping_late(
    records: DataFrame,
    key: str,
    ts: str,
    delay: str,
    kept: str,
    late: str,
    marks: str,
    checkpoint: str,
) -> StreamingQuery:
    """Each id once, rows behind the watermark apart, and the count of each.

    The watermark of a micro-batch is the newest time of those before it less the delay. Rows
    behind it, or without a time, go to ``late`` as they are, repeats of an id that came within
    the delay are left out, the others go to ``kept``; ``marks`` has a row for each micro-batch,
    and in it kept + late + repeats = rows. Ids already kept are looked up in the micro-batches
    that reach into twice the delay before the newest time, so the work does not grow with
    the stream's age. Null ids are one id.

    A micro-batch replaces its own partitions only and reads earlier ones, so that one
    repeated after a failure at any point leaves the same rows.
    """
    spark = records.sparkSession
    wait = F.expr(f"INTERVAL {delay}")

    def write(batch: DataFrame, number: int) -> None:
        before = _marks_before(spark, marks, number)
        newest = max((t for _, t in before if t is not None), default=None)
        position = F.lit(newest).cast("timestamp")
        behind: Column = F.col(ts).isNull()
        if newest is not None:
            behind |= F.col(ts) < position - wait
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            once = dedup.keep_first(held.filter(~behind), [key], [ts, F.xxhash64(*held.columns)])
            layer = existing_layer(spark, kept)
            if layer is not None and newest is not None:
                reach = [n for n, t in before if t is not None and n < number]
                recent = layer.filter(F.col(BATCH).isin(reach) & (F.col(ts) >= position - wait - wait))
                known = recent.select(F.col(key).alias("_known")).distinct()
                once = once.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
            seen = Observation()
            _replace(once.observe(seen, F.count(F.lit(1)).alias("kept")), kept, number)
            _replace(held.filter(behind), late, number)
            total = held.agg(
                F.max(F.when(~behind, F.col(ts))).cast("timestamp").alias("newest"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(behind).alias("late"),
            )
            count = F.lit(observed(seen).get("kept", 0)).cast("bigint")
            row = total.select("newest", "rows", count.alias("kept"), "late",
                               (F.col("rows") - F.col("late") - count).alias("repeats"))
            _replace(row.coalesce(1), marks, number)
        finally:
            held.unpersist()

    query = (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
