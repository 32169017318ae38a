"""Packing documents into token sequences: concatenate and cut.

First pass: each task encodes its documents and stores their ids with their offset among
the task's own tokens. The totals of the tasks, one number each, are summed up in task
order; that gives each task the global offset of its first token. Second pass: every
document is cut at the multiples of the window, without a shuffle. Pieces at the cuts are
the boundary records. All windows but the last are full; the last is padded to the next
power of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import Batches, Rows, few_rows, stored, text_or_empty, tidy
from msgloom.llm.encoders import encoder, id_kind, slices

ENCODED = pa.schema([("part", pa.int32()), ("local", pa.int64()), ("doc_id", pa.int64()),
                     ("ids", pa.binary())])
ENCODED_SQL = "part int, local bigint, doc_id bigint, ids binary"
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64()), ("boundary", pa.bool_()), ("ids", pa.binary())])
PIECES_SQL = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint, boundary boolean, ids binary")  # fmt: skip


def _encode(vocab: str, end_id: int, kind: str):
    def encode(batches: Batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, local, out = TaskContext.get().partitionId(), 0, Rows(ENCODED)
        enc, end, width = encoder(vocab, kind), np.array([end_id], kind).tobytes(), np.dtype(kind).itemsize
        for batch in few_rows(batches, 1000):
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                for key, packed in zip(keys[a:b], enc.many(texts[a:b])):
                    packed += end
                    out.add(part, local, key, packed, weight=len(packed))
                    local += len(packed) // width
                yield from out.ready()
        yield from out.rest()
        enc.settle()

    return tidy(encode)


def _cut(window: int, kind: str, with_ids: bool):
    def cut(batches: Batches) -> Iterator[pa.RecordBatch]:
        out = Rows(PIECES)
        for batch in batches:
            for key, packed, first in zip(*(c.to_pylist() for c in batch.columns)):
                ids, at = np.frombuffer(packed, kind).astype("<u4"), 0
                while at < len(ids):
                    sequence, offset = divmod(first + at, window)
                    piece = ids[at : at + window - offset]
                    data = piece.tobytes()
                    out.add(key, at, len(piece), zlib.crc32(data), len(ids), sequence, offset,
                            at > 0 or len(piece) < len(ids), data if with_ids else None,
                            weight=len(data) * with_ids)
                    at += len(piece)
                yield from out.ready()
        yield from out.rest()

    return tidy(cut)


def pack(docs: DataFrame, window: int = 4096, vocab: str = "word_bpe_49k.json", end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    ``padded_to`` is the length of the piece's sequence, ``window`` for all but the last.
    ``boundary`` marks pieces of documents that a cut divides. With ``with_ids`` the packed
    ids (unsigned, little-endian, 32 bits) come along. A null text is empty and gives the
    end id alone; null and repeated keys are packed like any; no other column is read; an
    empty table gives no row.
    """
    kind = id_kind(vocab) if end_id < 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    encoded = stored(rows.mapInArrow(_encode(vocab, end_id, kind), ENCODED_SQL), "packing")
    width = np.dtype(kind).itemsize
    # One row for each task of the first pass, which Spark's driver keeps a record of anyway:
    # that bounds the window and the broadcast.
    totals = encoded.groupBy("part").agg(F.sum(F.octet_length("ids") / width).cast("long").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = encoded.join(F.broadcast(bases), "part")
    pieces = placed.select("doc_id", "ids", (F.col("base") + F.col("local")).alias("first"))
    cut = pieces.mapInArrow(_cut(window, kind, with_ids), PIECES_SQL)
    count = totals.agg(F.sum("n")).first()[0] or 0
    last, left = count // window, count % window
    final = 1 << (left - 1).bit_length() if left else window
    return cut.withColumn("padded_to", F.when(F.col("sequence_id") == last, final).otherwise(window)
                          .cast("long"))


def sequences(pieces: DataFrame, window: int = 4096, pad_id: int = 0) -> DataFrame:
    """sequence_id and its padded ids (binary), from pieces that carry their ids.

    A sequence has at most ``window`` ids, so no group grows with the data.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    room = F.array_repeat(pad, (F.col("padded_to") - F.octet_length("ids") / 4).cast("int"))
    return (
        pieces.groupBy("sequence_id", "padded_to").agg(joined.alias("ids"))
        .select("sequence_id", F.aggregate(room, F.col("ids"), lambda a, p: F.concat(a, p)).alias("ids"))
    )
