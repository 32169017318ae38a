"""What the operators share: input columns, the work folder, files from inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.session import shared_dir, shuffles_freed

Batches = Iterator[pa.RecordBatch]


def text_or_empty(name: str = "text") -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stored(
    df: DataFrame, name: str, partition_by: tuple[str, ...] = (), made: list[str] | None = None
) -> DataFrame:
    """Write a result to the shared folder and read it back.

    Cuts the lineage: a lost executor costs no more than the tasks it was running, and
    what reads the result twice does not work it out twice. The shuffle files that it took
    are removed. The folder is added to ``made``, for a caller that removes it later.
    """
    path = shared_dir(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    with shuffles_freed(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer where the frame has columns of those names."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
        taken.add(name.lower())
    return found


def batch_of(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema
    )


def few_rows(batches: Batches, rows: int = 500) -> Batches:
    """The same rows in short batches, so that few texts at once are Python's own strings.

    A worker keeps the memory that its largest batch of strings has taken.
    """
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def tidy(task):
    """The same function of a task's batches, which gives free memory back to the system at its end.

    Workers serve task after task: without that, each keeps the most that any of them took.
    """

    def run(batches: Batches) -> Batches:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if trim:
            trim(0)

    return run


class Rows:
    """Output rows of a task, given out as batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 20_000, size: int = 16 << 20):
        self.schema, self.rows, self.size = schema, rows, size
        self.clear()

    def clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.weight = 0

    def add(self, *values: object, weight: int = 0) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)
        self.weight += weight

    def ready(self) -> Iterator[pa.RecordBatch]:
        if len(self.columns[0]) >= self.rows or self.weight >= self.size:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            yield batch_of(self.schema, self.columns)
            self.clear()


def packed_texts(once: bool = False):
    """Compresses the last column, a text, before a shuffle.

    With ``once`` a task gives one row for each value of the first column.
    """
    import zstandard

    def pack(batches: Batches) -> Iterator[pa.RecordBatch]:
        squeeze, seen = zstandard.ZstdCompressor(level=1).compress, set()
        for batch in few_rows(batches):
            if once:
                keys = batch.column(0).to_pylist()
                new = [k not in seen and not seen.add(k) for k in keys]
                batch = batch.filter(pa.array(new, pa.bool_()))
            data = [squeeze(t.encode()) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(data, pa.binary())],
                                             names=[*batch.schema.names[:-1], "packed"])

    return pack


def open_folder(uri: str):
    """The file system of a shared folder and the path in it, from inside a task."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)
