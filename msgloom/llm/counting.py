"""Counts of hashes in a table of fixed size, filled by tasks and added up."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from msgloom.llm.common import Batches

BLOCKS = 64


def cells_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The cell of each 64-bit hash: its leading bits."""
    return (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def packed_blocks(cells: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A task's counts as blocks, without those that are empty."""
    for block, part in enumerate(np.split(cells.astype(np.uint32), BLOCKS)):
        if part.any():
            yield block, zlib.compress(part.tobytes(), 1)


def _added_up(batches: Batches) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.uint64)
            sums[block] = sums[block] + part if block in sums else part
    for block, part in sums.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()),
                                          "counts": pa.array([part.tobytes()], pa.binary())})


def total(blocks: DataFrame, bits: int) -> np.ndarray:
    """The counts of all tasks from rows of (block, counts); the table's size is fixed."""
    made = np.zeros((BLOCKS, (1 << bits) // BLOCKS), np.uint64)
    summed = blocks.repartition(BLOCKS, "block").mapInArrow(_added_up, "block int, counts binary")
    for row in summed.collect():  # BLOCKS rows at most
        made[row["block"]] = np.frombuffer(row["counts"], np.uint64)
    return made.ravel()
