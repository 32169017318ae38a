"""Embedding whitening with MLlib block matrices.

Each task lays its rows into blocks and stores them with their sums: the rows' places are
the task's blocks behind those of the tasks before it (prefix sums over one count per task).
The centred blocks are a ``BlockMatrix`` A. A's transpose times A is the scatter, whose blocks
are added up over the row blocks in many tasks; its eigenvectors come from a local ``eigh``.
A second product of block matrices, A times the whitening matrix, projects the rows, and the
transpose of that times itself checks the result: its covariance is the identity.

Blocks go between DataFrames and MLlib as a column of matrices, through Arrow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom.llm.common import Batches, Rows, stored

# A block has at most so many entries (8 MB as doubles); with few columns so many rows.
BLOCK_ENTRIES = 1 << 20
BLOCK_ROWS = 1 << 13
BLOCK_COLUMNS = 1 << 10
# Components under this share of the largest eigenvalue have no variance beyond rounding.
NO_VARIANCE = 1e-12
# Entries beyond this are no numbers that 64 * c + 1000000 could tell apart as a double.
LARGEST = float(1 << 52)

BLOCK_SQL = "part int, place int, width int, n int, ids array<bigint>, x array<bigint>, sums array<bigint>"
BLOCK = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("width", pa.int32()), ("n", pa.int32()),
                   ("ids", pa.list_(pa.int64())), ("x", pa.list_(pa.int64())),
                   ("sums", pa.list_(pa.int64()))])
_ROW_COLUMN = pa.struct([pa.field("row", pa.int64(), False), pa.field("column", pa.int64(), False)])
_MATRIX = pa.struct([
    pa.field("type", pa.int8(), False), pa.field("numRows", pa.int32(), False),
    pa.field("numCols", pa.int32(), False), ("colPtrs", pa.list_(pa.int32())),
    ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())),
    pa.field("isTransposed", pa.bool_(), False),
])
MATRIX_BLOCKS = T.StructType([
    T.StructField("place", T.StructType([T.StructField("row", T.LongType(), False),
                                         T.StructField("column", T.LongType(), False)])),
    T.StructField("matrix", MatrixUDT()),
])


@dataclass
class Whitening:
    """What was fitted: the fit list's size and sums, the components and their share of variance."""

    n: int
    sums: list[int]
    components: np.ndarray  # a unit eigenvector in each column
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def matrix(self) -> np.ndarray:
        return self.components / np.sqrt(self.eigenvalues)


def rows_in_block(width: int) -> int:
    return max(1, min(BLOCK_ROWS, BLOCK_ENTRIES // max(width, 1)))


def _blocks(scale: float, offset: int):
    """Whole vectors, rounded down to numbers of ``1 / scale``, in blocks of one width each."""

    def make(batches: Batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def block(width: int) -> pa.RecordBatch:
            nonlocal place
            ids = pa.concat_arrays([i for i, _ in held[width]])
            x = np.concatenate([v for _, v in held.pop(width)])
            out, place = Rows(BLOCK), place + 1
            out.add(part, place - 1, width, len(x), ids.to_pylist(), x.ravel(), x.sum(axis=0))
            return next(out.rest())

        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            sizes = np.diff(vectors.offsets.to_numpy())
            entries = vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for width in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == width)
                at = (ends[rows] - width)[:, None] + np.arange(width)
                x = np.floor(scale * entries[at].astype(np.float64)).astype(np.int64) + offset
                step = rows_in_block(width)
                for a in range(0, len(rows), step):
                    held.setdefault(width, []).append((ids.take(pa.array(rows[a : a + step])), x[a : a + step]))
                    if sum(len(v) for _, v in held[width]) >= step:
                        yield block(width)
        for width in list(held):
            yield block(width)

    return make


def row_blocks(df: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    """Stored blocks of the usable rows of the commonest width, with their number ``row``.

    A block comes from one task, so it may hold fewer rows than there is room for: the rest
    counts as rows of zeros, which add nothing to any product.
    """
    vector = F.col(vector_col).cast("array<double>")
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < LARGEST))
    rows = df.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))
    rows = rows.filter(usable & (F.size(vector) > 0)).select("id", F.col("v"))
    blocks = stored(rows.mapInArrow(_blocks(scale, offset), BLOCK_SQL), "whitening-rows")
    widths = blocks.groupBy("width").agg(F.sum("n").alias("n"))
    common = widths.orderBy(F.desc("n"), F.desc("width")).first()
    blocks = blocks.filter(F.col("width") == (common["width"] if common else 0))
    # One row for each task that wrote blocks, as Spark's driver keeps anyway.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = blocks.groupBy("part").agg((F.max("place") + 1).cast("long").alias("n"))
    bases = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(bases), "part").withColumn("row", F.col("base") + F.col("place")).drop("base")


def _centred(sums: list[int], n: int):
    """Blocks of x - S / n. The whole part of the mean goes first, exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s - s // n * n) / n for s in sums])
    width = len(sums)

    def centre(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = x.values.to_numpy().reshape(-1, width) - whole - rest
                places, matrices = [], []
                for column, a in enumerate(range(0, width, BLOCK_COLUMNS)):
                    piece = np.ascontiguousarray(x[:, a : a + BLOCK_COLUMNS])
                    places.append({"row": row, "column": column})
                    # Values by rows; for MLlib, whose order is by columns, that is a transposed one.
                    matrices.append({"type": 1, "numRows": piece.shape[0], "numCols": piece.shape[1],
                                     "colPtrs": None, "rowIndices": None, "values": piece.ravel(),
                                     "isTransposed": True})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places, _ROW_COLUMN), pa.array(matrices, _MATRIX)], names=["place", "matrix"]
                )

    return centre


def block_matrix(blocks: DataFrame, rows: int, columns: int) -> BlockMatrix:
    """A distributed matrix from rows of (row and column of the block, matrix)."""
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, rows, columns, 0, 0), rows, columns)


def times(left: BlockMatrix, right: BlockMatrix, pieces: int = 1) -> BlockMatrix:
    """The product; the sum over the inner dimension is cut into ``pieces`` for as many tasks."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, pieces)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def scatter(matrix: BlockMatrix, pieces: int) -> np.ndarray:
    """The transpose times the matrix: as many rows and columns as a vector has entries."""
    return times(matrix.transpose(), matrix, pieces).toLocalMatrix().toArray()


def fit(matrix: BlockMatrix, n: int, sums: list[int], components: int, pieces: int) -> Whitening:
    """Components by falling eigenvalue, without those that have no variance."""
    covariance = scatter(matrix, pieces) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    alive = values > NO_VARIANCE * max(values[0], 0.0)
    values, vectors = values[alive], vectors[:, alive]
    return Whitening(n, sums, vectors, values, values / np.trace(covariance))


def _rows(columns: int, sums: list[int], n: int):
    """Each vector's id, distance from the mean and projection, from blocks of all three."""
    from decimal import Decimal

    whole = np.array([s // n for s in sums], np.int64)
    rest = [s - s // n * n for s in sums]
    exact = (max(rest, default=0) + n * (1 << 20)) ** 2 * max(len(sums), 1) < 1 << 62
    schema = pa.schema([("id", pa.int64()), ("deviation", pa.decimal128(38, 0)),
                        ("whitened", pa.list_(pa.float64()))])

    def give(batches: Batches) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for ids, x, values in zip(*(batch.column(k) for k in range(3))):
                x = x.values.to_numpy().reshape(-1, len(sums)) - whole
                near = exact and np.abs(x).max(initial=0) < 1 << 20
                # Whole numbers of any size, unless all fit into 64 bits.
                away = n * (x if near else x.astype(object)) - np.array(rest, np.int64 if near else object)
                deviations = (away * away).sum(axis=1).tolist()
                made = values.values.to_numpy().reshape(-1, columns)
                for key, deviation, row in zip(ids.as_py(), deviations, made):
                    out.add(key, Decimal(deviation) if deviation < 10**38 else None, row, weight=8 * columns)
                yield from out.ready()
        yield from out.rest()

    return give


def _values(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Row number and values, by rows, of matrix blocks."""
    for batch in batches:
        for place, matrix in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = matrix["values"].values.to_numpy()
            if not matrix["isTransposed"].as_py():
                values = values.reshape(matrix["numCols"].as_py(), -1).T
            out = {"row": pa.array([place["_1"]], pa.int64()),
                   "values": pa.array([values.ravel()], pa.list_(pa.float64()))}
            yield pa.RecordBatch.from_pydict(out)


def _matrices(columns: int):
    """Matrix blocks again from stored row numbers and values."""

    def make(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                matrix = {"type": 1, "numRows": len(values) // columns, "numCols": columns, "colPtrs": None,
                          "rowIndices": None, "values": values.values.to_numpy(), "isTransposed": True}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([{"row": row, "column": 0}], _ROW_COLUMN), pa.array([matrix], _MATRIX)],
                    names=["place", "matrix"],
                )

    return make


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32,
           scale: float = 64.0, offset: int = 1_000_000) -> tuple[DataFrame, Whitening | None]:
    """One row per usable vector: id, deviation and ``whitened`` (an array); and the fit.

    A vector's entries c count as floor(scale * c) + offset. ``deviation`` is the sum over the
    dimensions of (n * x - S) ** 2, exact (null from 10 ** 38 on). All covariances are over all
    usable vectors, divided by their number, centred first.

    Rows whose vector is null, empty, of another length than most (of two as common, the
    longer stays) or holds a null, an entry that is not finite or beyond 2 ** 52 / scale are
    left out. Null and repeated ids and repeated rows stay, a row each. Components without
    variance are not given, so equal vectors, or one vector alone, have none; then, and for
    an empty table, there are no rows and the fit is None. Other columns are not read.
    """
    if components < 1:
        raise ValueError("at least one component")
    spark = df.sparkSession
    blocks = row_blocks(df, id_col, vector_col, scale, offset)
    # As many numbers as a vector has entries.
    summed = blocks.select("n", F.posexplode("sums").alias("d", "s")).groupBy("d").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"))
    sums = sorted(map(tuple, summed.collect()))
    empty = spark.createDataFrame([], "id bigint, deviation decimal(38,0), whitened array<double>")
    if not sums:
        return empty, None
    n, sums = sums[0][2], [s for _, s, _ in sums]
    width, step = min(len(sums), BLOCK_COLUMNS), rows_in_block(len(sums))
    centred = blocks.select("row", "x").mapInArrow(_centred(sums, n), MATRIX_BLOCKS)
    matrix = block_matrix(centred, step, width)
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not any(s % n for s in sums) and not _varies(blocks, sums, n):
        return empty, None
    fitted = fit(matrix, n, sums, components, pieces)
    kept = len(fitted.eigenvalues)
    parts = np.split(fitted.matrix, range(width, len(sums), width))
    turning = spark.createDataFrame(
        [((i, 0), DenseMatrix(len(part), kept, part.ravel(order="F"))) for i, part in enumerate(parts)], MATRIX_BLOCKS
    )
    projected = times(matrix, block_matrix(turning, width, kept))
    made = callMLlibFunc("getMatrixBlocks", projected._java_matrix_wrapper._java_model)
    values = stored(made.mapInArrow(_values, "row bigint, values array<double>"), "whitening-values")
    # The rows are projections of centred ones, so they are centred too.
    again = block_matrix(values.mapInArrow(_matrices(kept), MATRIX_BLOCKS), step, kept)
    fitted.identity_error = float(np.abs(scatter(again, pieces) / n - np.eye(kept)).max())
    joined = blocks.select("row", "ids", "x").join(values, "row").select("ids", "x", "values")
    schema = "id bigint, deviation decimal(38,0), whitened array<double>"
    return joined.mapInArrow(_rows(kept, sums, n), schema), fitted


def _varies(blocks: DataFrame, sums: list[int], n: int) -> bool:
    """Whether any entry differs from its mean, where all means are whole numbers."""
    mean = np.array([s // n for s in sums], np.int64)

    def differ(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bool((x.values.to_numpy().reshape(-1, len(mean)) != mean).any()) for x in batch.column(0)]
            yield pa.RecordBatch.from_pydict({"differs": pa.array(found, pa.bool_())})

    return not blocks.select("x").mapInArrow(differ, "differs boolean").filter("differs").isEmpty()


def components_of(rows: DataFrame, fitted: Whitening | None) -> DataFrame:
    """A row for each vector and component, with the fit's figures."""
    given = rows.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(e)) for e in fitted.explained]) if fitted else F.array(F.lit(0.0))
    return given.select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n if fitted else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(shares, "at").alias("explained"),
        F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"),
    )
