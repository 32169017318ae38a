"""Writers. Each names its own write options and leaves the session's settings alone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from msgloom.functions.times import date_parts
from msgloom.operators.aggregate import observed
from msgloom.schemas import RUN_LOG
from msgloom.session import shuffles_freed

Sink = Callable[[DataFrame], None]
Projection = Callable[[DataFrame], DataFrame]


def compact(df: DataFrame, *keys: str) -> DataFrame:
    """Gather small output files per partition folder.

    Rebalancing lets adaptive execution cut a folder that holds very many rows into
    several files and join small ones; a plain repartition would give each one task.
    """
    return df.hint("rebalance", *keys)


def append_layer(df: DataFrame, path: str, partition: str = "processing_date") -> None:
    """Add rows to a layer below their run-date folder."""
    writer = df.write.mode("append").option("compression", "zstd").partitionBy(partition)
    with shuffles_freed(df.sparkSession):
        writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace exactly the partition folders the rows fall into; a rerun gives the same.

    Ids that are hashes make up much of a layer; zstd halves their hex digits, snappy does not.
    """
    writer = df.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd")
    with shuffles_freed(df.sparkSession):
        writer.partitionBy(*keys).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, keys: Sequence[str], present: Sequence[Sequence[object]], name: str
) -> None:
    """Replace the partitions in ``present``: those without a row any more are removed.

    Which partitions have rows is observed on the write; a partition not in ``present``
    stays as it is. The list holds one entry per folder.
    """
    seen = Observation(name)
    texts = F.struct(*[F.col(k).cast("string").alias(k) for k in keys])
    overwrite_partitions(df.observe(seen, F.collect_set(texts).alias("written")), path, keys)
    written = {tuple(row) for row in observed(seen).get("written", [])}
    for values in present:
        if tuple(map(str, values)) not in written:
            folder = "/".join(f"{k}={v}" for k, v in zip(keys, values))
            remove_folder(df.sparkSession, f"{path}/{folder}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Spark writes to; none there is no error."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """The folders right below a folder, oldest name first; none if there is no such folder."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return sorted(str(s.getPath().toString()) for s in system.listStatus(folder) if s.isDirectory())


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has ended."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def append_unified(df: DataFrame, path: str) -> None:
    """Add rows to the unpartitioned unified layer."""
    df.write.mode("append").parquet(path)


def append_table(
    df: DataFrame, table: str, partitions: Sequence[str], path: str | None = None
) -> None:
    """Create the catalog table with its partitions on the first call, then append by name."""
    writer = df.write.format("parquet").partitionBy(*partitions).mode("append").option("compression", "zstd")
    if path and not df.sparkSession.catalog.tableExists(table):
        writer = writer.option("path", path)
    with shuffles_freed(df.sparkSession):
        writer.saveAsTable(table)


def write_ndjson(
    df: DataFrame,
    path: str,
    max_records: int,
    partition_by: Sequence[str] = (),
    compression: str | None = None,
) -> None:
    """JSON lines in files of at most ``max_records`` rows; folders given are replaced.

    A compressed file is read by one task, so that the number of rows bounds that task.
    """
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.json(path)


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = None) -> None:
    """CSV with a header; texts that hold a comma, quote or line break are quoted.

    Empty texts and nulls are both written as nothing between the commas; blanks at the ends
    of a text stay. Files whose texts hold line breaks are read whole by one task each,
    compressed or not.
    """
    options = {"header": header, "escape": '"', "emptyValue": "",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").options(**options).csv(path, compression=compression)


def write_lines(
    df: DataFrame, path: str, line: str = "value", compression: str | None = None, max_records: int = 0
) -> None:
    """Lines of text as they are, in files of at most ``max_records`` rows if that is given.

    A compressed file is read by one task, so that the number of rows bounds that task.
    """
    writer = df.select(line).write.mode("overwrite").option("maxRecordsPerFile", max_records)
    with shuffles_freed(df.sparkSession):
        writer.text(path, compression=compression)


def fan_out(df: DataFrame, outputs: Sequence[tuple[Projection, Sink]]) -> None:
    """One input, several projections, each to its own sink; the input is computed once."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for projection, sink in outputs:
            sink(projection(held))
    finally:
        held.unpersist()


def write_partitioned_by_time(df: DataFrame, ts: str, path: str, mode: str = "append") -> None:
    """JSON lines in year, month and day folders of a time column."""
    parts = date_parts(F.col(ts))
    dated = compact(df.withColumns(parts), *parts)
    dated.write.mode(mode).partitionBy(*parts).json(path)


def guard_empty(df: DataFrame, sink: Sink) -> bool:
    """Write only if there is a row; whether it wrote.

    Spark stops at the first row it finds, and the frame is not counted.
    """
    if df.isEmpty():
        return False
    sink(df)
    return True


def write_run_log(
    spark: SparkSession,
    path: str,
    run_id: str,
    job: str,
    as_of: dt.datetime,
    metrics: Mapping[str, int] | None = None,
    total_records: int | None = None,
    start_cursor: str | None = None,
    end_cursor: str | None = None,
    error: str | None = None,
) -> None:
    """Add one row on a run: completed, or failed with the error."""
    status = "failed" if error else "completed"
    row = (run_id, job, as_of, status, total_records, start_cursor, end_cursor,
           dict(metrics or {}), error)
    spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(path)
