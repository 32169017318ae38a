"""Token counts by overlap resynchronisation.

Texts up to ``chunk_chars`` are counted whole. A longer text is cut into overlapping
chunks, which are spread over tasks and encoded with offsets. Two neighbours are joined at
a position in their overlap where both start a piece of the vocabulary's pattern. That
position is proven stable: the pattern is matched from left to right and looks ahead only,
so two scans that are at one position go on alike, and the first scan is right up to its
last pieces, which the end of its chunk may have changed and which are left aside. Where no
common position is found, the text is cut again with chunks and overlaps four times as
long, until one chunk holds it whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import Batches, Rows, stored, text_or_empty
from msgloom.llm.encoders import encoder, slices, tokenizer

COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
COUNTED_SQL = "doc_id bigint, n_bytes bigint, n_tokens bigint"
CHUNK = pa.schema([("row_key", pa.string()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                   ("chunk", pa.int64()), ("last", pa.bool_()), ("start", pa.int64()),
                   ("text", pa.string())])
CHUNK_SQL = ("row_key string, doc_id bigint, n_bytes bigint, chunk bigint, last boolean, "
             "start bigint, text string")  # fmt: skip
MARKS_SQL = ("row_key string, doc_id bigint, n_bytes bigint, chunk bigint, last boolean, total bigint, "
             "head map<bigint,bigint>, tail map<bigint,bigint>")  # fmt: skip
# No special text is longer; marks nearer to a chunk's end are not used.
GUARD = 64


def _count_whole(vocab: str):
    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab, counts=True)
        for batch in batches:
            ids, sizes = batch.column(0), batch.column(2)
            texts = batch.column(1).to_pylist()
            counts = [n for a, b in slices(texts) for n in enc.many(texts[a:b])]
            yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(counts, pa.int64())], schema=COUNTED)

    return count


def _cut(chunk: int, overlap: int):
    def cut(batches: Batches) -> Iterator[pa.RecordBatch]:
        import xxhash

        out = Rows(CHUNK)
        for batch in batches:
            for doc_id, text, n_bytes in zip(*(c.to_pylist() for c in batch.columns)):
                key = xxhash.xxh3_128_hexdigest(f"{doc_id}\n{text}".encode())
                step = chunk - overlap
                for i, start in enumerate(range(0, max(1, len(text) - overlap), step)):
                    piece = text[start : start + chunk]
                    out.add(key, doc_id, n_bytes, i, start + chunk >= len(text), start, piece,
                            weight=len(piece))
                    yield from out.ready()
        yield from out.rest()

    return cut


def piece_starts(encoding) -> dict[int, int]:
    """Where pieces of the pattern start in a text, with the tokens before each."""
    starts, before = {}, None
    for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word != before:
            starts[start] = i
            before = word
    return starts


def _mark(vocab: str, overlap: int):
    def mark(batches: Batches) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocab)
        for batch in batches:
            rows = batch.to_pydict()
            total, heads, tails = [], [], []
            for text, start, last in zip(rows["text"], rows["start"], rows["last"]):
                encoding = tok.encode(text, add_special_tokens=False)
                starts = sorted(piece_starts(encoding).items())
                total.append(len(encoding))
                heads.append([(start + p, n) for p, n in starts if p < overlap] if start else [])
                # The last two pieces may be cut short by the end of the chunk.
                sure = [] if last else starts[:-2]
                low, high = len(text) - overlap, len(text) - GUARD
                tails.append([(start + p, n) for p, n in sure if low <= p < high])
            pairs = pa.map_(pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(5)]
                + [pa.array(total, pa.int64()), pa.array(heads, pairs), pa.array(tails, pairs)],
                names=["row_key", "doc_id", "n_bytes", "chunk", "last", "total", "head", "tail"],
            )

    return mark


def _spliced(marks: DataFrame) -> DataFrame:
    """Per row of input: its tokens, null where two chunks have no common mark."""
    # Equal rows have equal keys and chunks; one set is joined and given out as often.
    one = marks.groupBy("row_key", "chunk").agg(
        F.count(F.lit(1)).alias("copies"),
        *(F.first(c).alias(c) for c in ("doc_id", "n_bytes", "last", "total", "head", "tail")),
    )
    order = Window.partitionBy("row_key").orderBy("chunk")
    at = F.array_min(F.array_intersect(F.map_keys("tail"), F.map_keys("next_head")))
    joined = (
        one.withColumn("next_head", F.lead("head").over(order))
        .withColumn("at", at)
        .withColumn("from", F.coalesce(F.lag(F.element_at("next_head", F.col("at"))).over(order),
                                       F.when(F.col("chunk") == 0, 0)))
        .withColumn("to", F.when(F.col("last"), F.col("total"))
                    .otherwise(F.element_at("tail", F.col("at"))))
    )
    return joined.groupBy("row_key").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_bytes").alias("n_bytes"),
        F.max("copies").alias("copies"),
        F.when(F.count("to") + F.count("from") == 2 * F.count(F.lit(1)),
               F.sum(F.col("to") - F.col("from"))).alias("n_tokens"),
    )


def count_tokens(docs: DataFrame, vocab: str = "byte_bpe_50k.json", chunk_chars: int = 1 << 15,
                 overlap_chars: int = 1 << 10, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_bytes and n_tokens, one row for each row of ``docs``.

    A null text is empty and has no tokens; a null id stays; repeated rows are counted
    each; other columns are left out, whatever their names. An empty table gives none.
    """
    if not GUARD < overlap_chars <= chunk_chars // 2:
        raise ValueError("the overlap must be over 64 characters and at most half a chunk")
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    short = base.filter(F.length("text") <= chunk_chars).mapInArrow(_count_whole(vocab), COUNTED_SQL)
    results, chunk, overlap = [short], chunk_chars, overlap_chars
    rest = base.filter(F.length("text") > chunk_chars)
    while True:
        pieces = rest.mapInArrow(_cut(chunk, overlap), CHUNK_SQL).repartition("row_key", "chunk")
        done = stored(_spliced(pieces.mapInArrow(_mark(vocab, overlap), MARKS_SQL)), "token-counts")
        results.append(
            done.filter("n_tokens is not null")
            .withColumn("_", F.explode(F.sequence(F.lit(1), "copies")))
            .select("doc_id", "n_bytes", "n_tokens")
        )
        failed = done.filter("n_tokens is null").select("row_key")
        if failed.isEmpty():
            break
        key = F.col("row_key")
        rest = _with_keys(rest).join(failed, "row_key", "left_semi").drop(key)
        chunk, overlap = chunk * 4, overlap * 4
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _with_keys(docs: DataFrame) -> DataFrame:
    """The rows with the key that their chunks carry."""

    def keyed(batches: Batches) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys = [xxhash.xxh3_128_hexdigest(f"{i}\n{t}".encode()) for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.string())],
                                             names=["doc_id", "text", "n_bytes", "row_key"])

    return docs.mapInArrow(keyed, "doc_id bigint, text string, n_bytes bigint, row_key string")
