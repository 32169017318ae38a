"""Landing of a stream whose pages overlap: each key once, looked up by filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from msgloom.operators import dedup, known_ids
from msgloom.plans.notifications import existing_layer
from msgloom.sinks import writers

BATCH = "ingest_batch"


def land_once(
    records: DataFrame, key: str, order: list[str], target: str, filters: str, work: str, checkpoint: str
) -> StreamingQuery:
    """Each key's first record, in a folder for each micro-batch.

    Pages of an API overlap, so that a record may come again in any later page. Of a key's
    records in one micro-batch the first by ``order`` stays; keys of earlier micro-batches are
    looked up by the Bloom filters in ``filters``, and only the folders that these name are
    opened. Records without a key all stay. A micro-batch reads earlier folders only and
    replaces its own folder, filter part included, so that it may run again at any point.
    """
    spark = records.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        own = f"{work}/batch={number}"
        try:
            row = "_row"
            marked = held.withColumn(row, F.struct(*order))
            new = dedup.keep_first(marked, [key], order, "keep", row).drop(row)
            # Parts cover earlier micro-batches only, also where this one runs again.
            parts = known_ids.read_parts(spark, filters, number)
            layer = existing_layer(spark, target) if number else None
            if layer is not None:
                earlier = layer.filter(F.col(BATCH) < number)
                writers.remove_folder(spark, own)
                new = known_ids.anti_new_rows_by_filter(new, earlier, key, BATCH, parts, own)
            folder = f"{target}/{BATCH}={number}"
            new.write.mode("overwrite").parquet(folder)
            written = spark.read.schema(new.schema).parquet(folder).withColumn(BATCH, F.lit(number))
            known_ids.write_part(written, key, BATCH, filters, number)
        finally:
            held.unpersist()
            writers.remove_folder(spark, own)

    query = (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
