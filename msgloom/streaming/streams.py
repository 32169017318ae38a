"""Streaming forms of the batch operators: file sources, checkpoints, restartable sinks.

Every query runs with ``availableNow``: it takes in what is there, in as many micro-batches
as the source's limits ask for, and ends. A restart goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from msgloom.operators.dedup import latest_per_key
from msgloom.sinks.writers import fan_out


def read_files(
    spark: SparkSession, fmt: str, path: str, schema: T.StructType, **options: str | int
) -> DataFrame:
    """Stream of the files in a folder, each taken in once."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def _finish(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def incremental_landing(
    records: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """New files to Parquet; files seen before are not read again."""
    writer = records.writeStream.format("parquet").option("path", target)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _finish(writer, checkpoint)


def stream_dedup(records: DataFrame, key: str, ts: str, delay: str, salts: int = 1) -> DataFrame:
    """Each id once, as long as its repeats come within the delay of the first.

    The state holds the ids of that time only. Rows later than the delay are left out by
    the watermark, so choose it to cover the lateness of the source.

    Where copies of one id can make up much of a micro-batch, ``salts`` above 1 first
    reduces them per id and salt, spread over that many tasks, at the price of a second
    state. The salt is the task a row is read in: it only spreads, the second step decides.
    """
    timed = records.withWatermark(ts, delay)
    if salts > 1:
        salted = timed.withColumn("_salt", F.spark_partition_id() % salts)
        timed = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark([key])


def write_stream(records: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return _finish(records.writeStream.format("parquet").option("path", target), checkpoint)


def write_two(
    records: DataFrame,
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
) -> StreamingQuery:
    """One stream, several projections, each to its own folder (``{folder: projection}``).

    A micro-batch replaces the partition of its own number, so that one repeated after a
    failure between the outputs leaves no row twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        def sink(target: str) -> Callable[[DataFrame], None]:
            return lambda df: (
                df.withColumn("ingest_batch", F.lit(number))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("ingest_batch")
                .parquet(target)
            )

        fan_out(batch, [(projection, sink(target)) for target, projection in outputs.items()])

    return _finish(records.writeStream.foreachBatch(write), checkpoint)


def stream_first_touch(
    records: DataFrame, keys: Sequence[str], order: Sequence[str], target: str, checkpoint: str
) -> StreamingQuery:
    """First row per key over all that ever came, in whatever order it came.

    A running ``min_by`` holds one row per key as state; rows are reduced per key before
    they are shuffled to it. Keys whose first row changed go to the partition of the
    micro-batch; ``read_first_touch`` gives the current rows.
    """
    columns = [F.col(c) for c in records.columns if c not in keys]
    first = records.groupBy(*keys).agg(
        F.min_by(F.struct(*columns), F.struct(*order)).alias("_first")
    )

    def write(batch: DataFrame, number: int) -> None:
        (
            batch.withColumn("ingest_batch", F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ingest_batch")
            .parquet(target)
        )

    flat = first.select(*keys, "_first.*")
    return _finish(flat.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def read_first_touch(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The current first rows: of each key the one written last."""
    return latest_per_key(spark.read.parquet(target), keys, ["ingest_batch"]).drop("ingest_batch")
