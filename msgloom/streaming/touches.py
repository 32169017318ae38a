"""First touches of a stream with state that ends: one row per key, dropped after a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from msgloom.operators.dedup import keep_first
from msgloom.sinks.writers import remove_folder

BATCH = "ingest_batch"
MILLIS = "_millis"  # the row's time as a number, whatever the zone of a worker


class FirstTouch(StatefulProcessor):
    """Holds the first row of a key, gives it out when it changes and forgets it by a timer."""

    def __init__(self, keys: list[str], columns: list[str], order: list[str], held: T.StructType, keep_ms: int):
        self.names, self.columns, self.held, self.keep_ms = [*keys, *columns], columns, held, keep_ms
        self.order, self.at = [columns.index(c) for c in order], columns.index(MILLIS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", self.held)

    def _rank(self, row: tuple) -> tuple:
        # Nulls come first, as in Spark's order.
        return tuple((False,) if row[i] is None else (True, row[i]) for i in self.order)

    def handleInputRows(self, key: tuple, rows: Iterator, timerValues: object) -> Iterator:  # noqa: N802, N803
        from pyspark.sql import Row

        before = tuple(self.first.get()) if self.first.exists() else None
        first = before
        for row in rows:
            found = tuple(row["_row"][c] for c in self.columns)
            if first is None or self._rank(found) < self._rank(first):
                first = found
        if first is None or first == before:
            return
        self.first.update(first)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(first[self.at] + self.keep_ms)
        yield Row(*self.names)(*key, *first)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator:  # noqa: N802, N803
        self.first.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_first_touch_within(
    records: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    delay: str,
    keep_seconds: int,
    target: str,
    checkpoint: str,
) -> StreamingQuery:
    """First row per key, in whatever order rows come, with state for a time only.

    The state holds the first row of each key until the watermark (the newest time less the
    delay) has passed it by ``keep_seconds``. Until then a row that comes earlier in the
    ``order`` replaces it and is written as a new version, and other rows of the key are not
    written. A row that comes after that is written again; ``current_first_touch`` still gives
    the first of all versions, so the rows are those of the batch form as long as no row is
    later than the delay. Rows behind the watermark, and those without a time, are left out.

    Needs the RocksDB state store (``CLUSTER_SETTINGS``).
    """
    records = records.filter(F.col(ts).isNotNull()).withColumn(MILLIS, F.unix_millis(ts))
    columns = [c for c in records.columns if c not in keys]
    # Times are numbers inside the state: Python would give them back in another zone.
    times = [f.name for f in records.schema.fields if isinstance(f.dataType, T.TimestampType)]
    kinds = {f.name: T.StructField(f.name, T.LongType()) if f.name in times else f for f in records.schema.fields}
    held = T.StructType([T.StructField(c, kinds[c].dataType) for c in columns])
    out = T.StructType([T.StructField(c, kinds[c].dataType) for c in (*keys, *columns)])
    timed = records.withWatermark(ts, delay)
    packed = F.struct(*[F.unix_micros(c).alias(c) if c in times else F.col(c) for c in columns])
    timed = timed.select(*keys, ts, packed.alias("_row")) if ts not in keys else timed.select(*keys, packed.alias("_row"))
    processor = FirstTouch(list(keys), columns, list(order), held, keep_seconds * 1000)
    first = timed.groupBy(*keys).transformWithState(processor, out, "Update", "EventTime")

    def write(batch: DataFrame, number: int) -> None:
        (
            batch.drop(MILLIS)
            .withColumns({c: F.timestamp_micros(c) for c in times if c in columns})
            .withColumn(BATCH, F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(target)
        )

    query = (
        first.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def current_first_touch(
    spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The first rows: of each key the version that comes first."""
    return keep_first(spark.read.parquet(target), keys, [*order, BATCH]).drop(BATCH)


def compact_first_touch(
    spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str]
) -> None:
    """Leave one version of each key: the older ones are dropped from the written folders.

    To be run while no stream writes there. The newest folder takes the current rows and the
    others are removed after that; a failure in between leaves versions that the reader drops.
    """
    versions = spark.read.parquet(target)
    numbers = sorted(row[0] for row in versions.select(BATCH).distinct().collect())
    if len(numbers) < 2:
        return
    last = numbers[-1]
    # The current rows go to a folder of their own first: the one they replace is read for them.
    staged = f"{target}/_compacted"
    current_first_touch(spark, target, keys, order).write.mode("overwrite").parquet(staged)
    rows = spark.read.parquet(staged).withColumn(BATCH, F.lit(last))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(target)
    )
    for number in numbers[:-1]:
        remove_folder(spark, f"{target}/{BATCH}={number}")
    remove_folder(spark, staged)
